"""Quality rules: how far a document's histograms lie from those of its language.

DataFrame functions only. A text is read once, where it lies; what is measured of it, its
words among that, goes to a table, and only counts per language are exchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.shared import WORD
from sedimenta.scratch import materialize

#: Most frequent words of a language whose shares make its word histogram; all other words
#: share its last place. Words up to this length are always looked up, as those that any text
#: is held together by are short; longer ones where one of them is among the most frequent.
COMMON_WORDS = 16
COMMON_LENGTH = 4
#: Longer words are counted by hash first, in so many buckets a language.
LONG_BUCKETS = 4096
#: Language of documents without one.
UNKNOWN = "und"
#: Documents with fewer words, or more of them in repeated windows, fail in any language.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Fewer characters, or a language with fewer words in all, give no verdict by divergence.
MIN_CHARACTERS = 200
MIN_LANGUAGE_WORDS = 10_000
#: Jensen-Shannon distances (base 2, 0 to 1) beyond which a document fails. A histogram of
#: n words is off by chance in proportion to 1 / sqrt(n), which the second part allows for.
MAX_CHARACTER_DISTANCE = 0.35
MAX_WORD_DISTANCE = 0.25
WORD_ALLOWANCE = 1.0

#: Character classes, in the order they are taken out of a text, the commonest first; what
#: is left in the end is the class of other symbols.
CLASSES = {"lower": "[a-z]+", "blank": r"[\x20\x09-\x0D]+", "upper": "[A-Z]+", "digit": "[0-9]+", "wide": r"[^\x00-\x7F]+"}
SYMBOLS = "[^#*$%&|<>]+"


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _window_hashes(words: Column) -> Column:
    """A number per three-word window, equal for equal windows."""
    hashes = F.transform(words, lambda x: F.xxhash64(x))
    joined = lambda x, y: F.shiftleft(x, 1).bitwiseXOR(y)
    pairs = _let(hashes, lambda h: F.struct(h.alias("h"), F.zip_with(h, F.slice(h, 2, F.size(h)), joined).alias("p")))
    windows = _let(pairs, lambda x: F.zip_with(x["p"], F.slice(x["h"], 3, F.size(x["h"])), joined))
    return F.when(F.size(words) > 3, F.slice(windows, 1, F.size(words) - 2)).otherwise(F.array().cast("array<long>"))


def _twins(windows: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Elements of a sorted array that are like one beside them."""
    like = F.zip_with(windows, F.slice(windows, 2, F.size(windows)), lambda x, y: F.coalesce(same(x, y), F.lit(False)))
    return _let(like, lambda t: F.filter(windows, lambda _, j: F.get(t, j) | F.coalesce(F.get(t, j - 1), F.lit(False))))


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words within three-word windows that stand in ``words`` twice or more.

    Where no two hashes are equal nothing repeats, which most texts are done with. Else the
    windows are sorted as numbers, by as many bits of the hash as a position leaves, and
    those whose neighbours share these bits are sorted by their words: the count is exact.
    """

    def window(i: Column) -> Column:
        return F.struct(*[F.get(words, i + k).alias("abc"[k]) for k in range(3)], i.alias("i"))

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda x, y: F.least(F.coalesce(y - x, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    def repeated(candidates: Column, room: Column) -> Column:
        windows = F.array_sort(F.transform(candidates, lambda x: window(x.bitwiseAND(room - 1).cast("int"))))
        alike = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        starts = _let(windows, lambda s: F.sort_array(F.transform(_twins(s, alike), lambda x: x["i"])))
        return _let(starts, covered)

    def packed(room: Column) -> Column:
        placed = F.transform(hashes, lambda x, i: x.bitwiseAND(-room).bitwiseOR(i.cast("long")))
        near = lambda s: _twins(s, lambda x, y: x.bitwiseXOR(y).between(0, room - 1))
        return _let(_let(F.sort_array(placed), near), lambda c: repeated(c, room))

    room = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(words))))
    unlike = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(unlike, 0).otherwise(_let(room, packed)).cast("long")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms of equal length; each sums to 1."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.when(p.isNotNull(), _root(parts))


def _root(parts: Column) -> Column:
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x) / 2, F.lit(0.0)))


def _shares(counts: list[Column]) -> Column:
    total = reduce(Column.__add__, counts)
    return F.array(*[F.try_divide(c.cast("double"), total.cast("double")) for c in counts])


def _class_shares() -> Column:
    return _shares([F.col(k) for k in (*CLASSES, "other")])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, characters per class, n_symbols, n_dup_lines, n_words, n_repeat_words and
    the short and the long words of each document, by way of one pass over its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rest = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text.alias("text"))
    left = "text"
    for k, pattern in CLASSES.items():
        rest = rest.withColumn(f"without_{k}", F.regexp_replace(left, pattern, ""))
        rest = rest.withColumn(k, (F.length(left) - F.length(f"without_{k}")).cast("long"))
        left = f"without_{k}"
    measured = rest.select(
        "doc_id", "lang", *CLASSES, F.length(left).cast("long").alias("other"),
        F.length(F.regexp_replace(left, SYMBOLS, "")).cast("long").alias("n_symbols"),
        _duplicate_lines(F.col("text")).alias("n_dup_lines"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
    )
    measured = measured.withColumn("hashes", _window_hashes(F.col("words")))
    return measured.select(
        "doc_id", "lang", *CLASSES, "other", "n_symbols", "n_dup_lines", F.size("words").cast("long").alias("n_words"),
        _repeat_words(F.col("words"), F.col("hashes")).alias("n_repeat_words"),
        F.filter("words", lambda w: F.length(w) <= COMMON_LENGTH).alias("short_words"),
        F.filter("words", lambda w: F.length(w) > COMMON_LENGTH).alias("long_words"),
    )


def language_references(measured: DataFrame, common_words: int = COMMON_WORDS) -> DataFrame:
    """A row per language of ``measures``: its words in all, its most frequent words
    (ties to the smaller), their shares with that of all others last, and those of the classes."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")

    def first(counted: DataFrame) -> DataFrame:
        return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= common_words)

    count = F.count("*").alias("n")
    short = first(measured.select("lang", F.explode("short_words").alias("word")).groupBy("lang", "word").agg(count))
    short = materialize(short, "short")
    # a long word is no more frequent than its bucket, and must reach the last of the short ones
    least = short.where(F.col("place") == common_words).select("lang", F.col("n").alias("least"))
    long = measured.select("lang", F.explode("long_words").alias("word"))
    long = long.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(LONG_BUCKETS)))
    likely = long.groupBy("lang", "bucket").agg(count).join(least, "lang", "left").where("n >= coalesce(least, 0)")
    likely = materialize(likely.select("lang", "bucket"), "buckets")
    long = long.join(likely, ["lang", "bucket"], "left_semi").groupBy("lang", "word").agg(count)
    top = first(short.drop("place").unionByName(long))
    top = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    totals = measured.groupBy("lang").agg(F.sum("n_words").alias("language_words"), *[F.sum(k).alias(k) for k in (*CLASSES, "other")])
    shares = F.transform("top", lambda t: t["n"] / F.col("language_words"))
    rest = F.lit(1.0) - F.aggregate(shares, F.lit(0.0), lambda total, x: total + x)
    return top.join(totals, "lang").select(
        "lang", "language_words", F.transform("top", lambda t: t["word"]).alias("common"),
        F.concat(shares, F.array(F.greatest(rest, F.lit(0.0)))).alias("word_shares"), _class_shares().alias("class_shares"),
    )


def rule_verdicts(docs: DataFrame, common_words: int = COMMON_WORDS) -> DataFrame:
    """doc_id, the base measures, both distances and ``kept``, a row per document.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows.
    Otherwise a document fails if the histogram of its character classes, or that of its
    language's common words, is too far from the language's own, learned from all documents
    of that language. A distance is null, and no reason to fail, where the text or the
    language has too little to go by.

    Null and empty texts have no words and fail; null languages are ``und``. Equal rows get
    equal rows, ids may be null, no documents give no rows; further columns are ignored.
    """
    measured = materialize(measures(docs), "measures")
    joined = measured.join(materialize(language_references(measured, common_words), "references"), "lang", "left")
    characters = reduce(Column.__add__, [F.col(k) for k in (*CLASSES, "other")])

    def common_counts(hits: Column) -> Column:
        share = lambda n: n.cast("double") / F.col("n_words")
        each = F.transform(F.sequence(F.lit(1), F.size("common")), lambda k: share(F.size(F.filter(hits, lambda x: x == k))))
        return F.concat(each, F.array(1.0 - share(F.size(hits))))

    enough = (F.col("n_words") >= MIN_WORDS) & (F.col("language_words") >= MIN_LANGUAGE_WORDS)
    long = F.exists("common", lambda w: F.length(w) > COMMON_LENGTH)
    words = F.when(long, F.concat("short_words", "long_words")).otherwise(F.col("short_words"))
    hits = F.filter(F.transform(words, lambda w: F.array_position("common", w)), lambda k: k > 0)
    own_words = F.when(enough, _let(hits, common_counts))
    own_classes = F.when(enough & (characters >= MIN_CHARACTERS), _class_shares())
    counted = joined.select(
        "doc_id", "n_words", (characters - F.col("blank")).alias("word_chars"), "n_symbols", "n_dup_lines", "n_repeat_words",
        F.round(_let(own_classes, lambda p: _distance(p, F.col("class_shares"))), 6).alias("character_distance"),
        F.round(_let(own_words, lambda p: _distance(p, F.col("word_shares"))), 6).alias("word_distance"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = counted.withColumn("base_failed", base_failed)
    far = F.coalesce(F.col("character_distance") > MAX_CHARACTER_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > MAX_WORD_DISTANCE + WORD_ALLOWANCE / F.sqrt("n_words"), F.lit(False)
    )
    return verdict.withColumn("kept", ~F.col("base_failed") & ~far)
