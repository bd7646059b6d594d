"""Collocated phrases, mined as joins and counts over sorted relations of occurrences."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_map, mix, release, text_batches, text_buffers, word_blocks
from sedimenta.scratch import materialize, remove

#: Words of a phrase at most, occurrences that make it a candidate, phrases listed per language.
LONGEST = 5
SUPPORT = 100
LISTED = 2000
#: A phrase goes if a longer one that contains it has this percentage of its occurrences.
COVERED_PERCENT = 100
#: Language of documents without one.
UNKNOWN = "und"
#: Bytes of text in a chunk, whose occurrences are one row of a relation, a few MB long, and
#: how many such rows are read at a time.
CHUNK_BYTES = 2 << 20
READ_ROWS = 8
#: Bits of the filter for frequent groups, as a power of two: 2**26 bits are 8 MB.
FILTER_BITS = 26

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_SPACE = _BREAKS.copy()
_SPACE[[0x20, 0x09]] = True
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_LEVEL = "phrases array<long>, counts array<int>, steps array<int>, codes array<int>"
WORDS = f"lang string, words array<string>, {_LEVEL}"
PHRASES = f"lefts array<long>, rights array<long>, {_LEVEL}"
#: Occurrences that a task counts at a time.
COUNTED = 1 << 21


def _lists(kind: pa.DataType, rows: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat).cast(kind))


def _relation(phrases: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, dict]:
    """Where each distinct phrase stands first, and the columns of a relation sorted by place."""
    distinct, first, codes, counts = np.unique(phrases, return_index=True, return_inverse=True, return_counts=True)
    steps = np.diff(places, prepend=0)
    return first, {"phrases": distinct.view(np.int64), "counts": counts, "steps": steps, "codes": codes}


def _level_arrays(columns: dict) -> list[pa.Array]:
    return [
        _lists(pa.int64(), [columns["phrases"]]),
        *(_lists(pa.int32(), [columns[c]]) for c in ("counts", "steps", "codes")),
    ]


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows of about ``limit`` bytes at a time; a longer text is a chunk by itself."""
    held, size = [], 0
    for batch in batches:
        start = 0
        bounds = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("text")] or [0])
        for i in range(batch.num_rows):
            own = int(bounds[i]) - (int(bounds[start - 1]) if start else 0)
            if size + own >= limit:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, start = [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
            size += int(bounds[-1]) - (int(bounds[start - 1]) if start else 0)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The relation of single words: a row per chunk and language.

    The place of a word is its number, plus one for every piece begun before it in the
    chunk, so places follow each other only within a piece.
    """
    for table in _chunks(batches, CHUNK_BYTES):
        raw, offsets = text_buffers(table.column("text"))
        starts, ends, hashes = [], [], []
        for s, e, spans, at in word_blocks(raw, offsets, _SPACE):
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(spans(s, e))
        if not starts:
            continue
        starts, ends, hashes = np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)
        row = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.cumsum(_BREAKS[raw])[starts] + row
        places = np.arange(len(starts)) + np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)
        lang = table.column("lang").combine_chunks().dictionary_encode()
        of_word = lang.indices.to_numpy()[row]
        for k, name in enumerate(lang.dictionary.to_pylist()):
            own = np.flatnonzero(of_word == k)
            if not len(own):
                continue
            tag = np.frombuffer(blake2b(name.encode(), digest_size=8).digest(), np.uint64)
            first, columns = _relation(mix(hashes[own] ^ tag), places[own])
            words = [raw[a:b].tobytes().decode().translate(_LOWER) for a, b in zip(starts[own][first], ends[own][first])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.string()),
                    pa.array([words], pa.list_(pa.string())),
                    *_level_arrays(columns),
                ],
                names=["lang", "words", "phrases", "counts", "steps", "codes"],
            )


_LOWER = {c: c + 32 for c in range(65, 91)}


@contextmanager
def _few_rows(spark: SparkSession) -> Iterator[None]:
    """For jobs run within: rows that hold many values are read and sent by the few."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, str(READ_ROWS))
    try:
        with text_batches(spark, 1):
            yield
    finally:
        spark.conf.set(key, before)


def _filter(frequent: DataFrame, rows: int, most: int) -> tuple[int, np.ndarray]:
    """A filter of at most 2**``most`` bits that holds every phrase of ``frequent``.

    It may hold others too, whose occurrences are then counted in vain. What reaches the
    driver is the filter itself, so its size is bounded however many phrases there are.
    """
    bits = min(max(16 * rows, 1 << 10).bit_length(), most)
    slot = F.col("phrase").bitwiseAND(F.lit((1 << bits) - 1))
    cell = frequent.select(F.shiftright(slot, 6).cast("int").alias("cell"), F.expr("shiftleft(1L, int(phrase & 63))").alias("bit"))
    table = cell.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow()
    cells = np.zeros(1 << (bits - 6), np.int64)
    cells[table.column("cell").to_numpy()] = table.column("bit").to_numpy()
    return bits, cells


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each row of a relation merged with itself at the following place: the longer
    phrases, their places, and the phrases that begin and end them."""
    for batch in batches:
        for i in range(batch.num_rows):
            phrases, steps, codes = (batch.column(c)[i].values.to_numpy() for c in ("phrases", "steps", "codes"))
            places = np.cumsum(steps.astype(np.int64))
            at = np.flatnonzero(places[1:] == places[:-1] + 1)
            left, right = codes[at], codes[at + 1]
            ids = phrases.view(np.uint64)
            yield mix((ids * _LEFT)[left] ^ (ids * _RIGHT)[right]), places[at], phrases[left], phrases[right]


def _held(shared, bits: int, phrases: np.ndarray) -> np.ndarray:
    slot = phrases.view(np.int64) & np.int64((1 << bits) - 1)
    return (shared.value[slot >> 6] >> (slot & 63)) & 1 == 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the phrases one longer than those of a relation."""
    held: list[np.ndarray] = []

    def counts() -> pa.RecordBatch:
        distinct, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n, pa.int64())], ["phrase", "n"])

    for phrases, *_ in _merged(batches):
        held.append(phrases)
        if sum(map(len, held)) >= COUNTED:
            yield counts()
            held = []
    if held:
        yield counts()


def _narrowed(spark: SparkSession, bits: int, cells: np.ndarray, schema: list[str]):
    """A relation of words without those that are not frequent."""
    shared = spark.sparkContext.broadcast(cells)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                phrases, steps, codes = (batch.column(c)[i].values.to_numpy() for c in ("phrases", "steps", "codes"))
                kept = _held(shared, bits, phrases)[codes]
                places, words = np.cumsum(steps.astype(np.int64))[kept], phrases[codes[kept]]
                _, columns = _relation(words.view(np.uint64), places)
                yield pa.RecordBatch.from_arrays(_level_arrays(columns), schema)

    return narrow


def _extension(spark: SparkSession, bits: int, cells: np.ndarray):
    """The relation of the next length, semi-joined with its frequent groups."""
    shared = spark.sparkContext.broadcast(cells)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for phrases, places, left, right in _merged(batches):
            kept = _held(shared, bits, phrases)
            if kept.any():
                first, columns = _relation(phrases[kept], places[kept])
                yield pa.RecordBatch.from_arrays(
                    [_lists(pa.int64(), [left[kept][first]]), _lists(pa.int64(), [right[kept][first]]), *_level_arrays(columns)],
                    names=["lefts", "rights", "phrases", "counts", "steps", "codes"],
                )

    return extend


def _totals(relation: DataFrame) -> DataFrame:
    """All word occurrences of each language."""
    counts = relation.select("lang", F.explode("counts").alias("n"))
    return counts.groupBy("lang").agg(F.sum(F.col("n").cast("long")).alias("n"))


def _frequent_words(relation: DataFrame, support: int) -> DataFrame:
    groups = relation.select("lang", F.inline(F.arrays_zip("words", "phrases", "counts")))
    counted = groups.groupBy("lang", "words", "phrases").agg(F.sum(F.col("counts").cast("long")).alias("a"))
    return counted.where(F.col("a") >= support).select(
        "lang", F.col("words").alias("phrase_text"), F.col("phrases").alias("phrase"), "a",
        F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"),
        F.array("a").alias("starts"), F.array("a").alias("ends"),
    )


def _frequent_phrases(counted: DataFrame, relation: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases with their text and the counts of their beginnings and ends by length."""
    groups = relation.select(F.inline(F.arrays_zip("phrases", "lefts", "rights")))
    parts = groups.groupBy(F.col("phrases").alias("phrase")).agg(F.min("lefts").alias("left"), F.min("rights").alias("right"))
    left = shorter.select("lang", F.col("phrase").alias("left"), F.col("phrase_text").alias("before"), F.col("starts").alias("before_starts"))
    right = shorter.select(F.col("phrase").alias("right"), F.col("phrase_text").alias("after"), F.col("ends").alias("after_ends"))
    last = F.substring_index("after", " ", -1)
    return counted.join(parts, "phrase").join(left, "left").join(right, "right").select(
        "lang", F.concat_ws(" ", "before", last).alias("phrase_text"), "phrase", "a", "left", "right",
        F.concat("before_starts", F.array("a")).alias("starts"), F.concat("after_ends", F.array("a")).alias("ends"),
    )


def _weakest_cut(length: int) -> Column:
    """(score, k, l, r) of the cut with the lowest score, exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(18,0)")
    cuts = []
    for k in range(1, length):
        l, r = F.element_at("starts", k), F.element_at("ends", length - k)
        score = F.call_function("div", wide(F.col("a")) * wide(F.col("n")) * F.lit(1000).cast("decimal(4,0)"), wide(l) * wide(r))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def _next(relation: DataFrame, longer: DataFrame) -> DataFrame:
    """``longer``, written, in place of the relation it is made of."""
    written = materialize(longer, "occurrences")
    remove(relation)
    release(relation.sparkSession)
    return written


def mine_phrases(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    listed: int | None = LISTED,
    covered_percent: int = COVERED_PERCENT,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases that stick together best.

    The occurrences of all phrases of one length are a relation, sorted by place: a row per
    chunk of texts and language holds the places of its occurrences and, once per distinct
    phrase, what it is. Merged with itself at the following place a relation gives the
    phrases one longer: they are counted first, then the merge is repeated, semi-joined with
    the frequent groups and kept as the next relation. Only counts are exchanged, and a
    phrase that fills the corpus costs a row per task. Frequent groups reach the tasks as a
    filter of bounded size; what it lets through wrongly falls short of ``support`` later.

    Words and phrases are told apart by 64-bit hashes within a language. Null texts are
    empty, null languages ``und``; texts without words, and tables without rows, give no
    phrases. Repeated rows count each. No id is used; further columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    with text_batches(spark):
        relation = materialize(arrow_map(texts, _occurrences, WORDS), "occurrences")
    with _few_rows(spark):
        totals = materialize(_totals(relation), "totals")
        levels = [materialize(_frequent_words(relation, support), "frequent")]
        names = ["phrases", "counts", "steps", "codes"]
        rows = levels[0].count()
        narrow = _narrowed(spark, *_filter(levels[0], rows, filter_bits), names)
        relation = _next(relation, arrow_map(relation.select(*names), narrow, _LEVEL))
        for _ in range(2, longest + 1):
            occurrences = relation.select("phrases", "steps", "codes")
            counted = arrow_map(occurrences, _counted, "phrase long, n long").groupBy("phrase").agg(F.sum("n").alias("a"))
            counted = materialize(counted.where(F.col("a") >= support), "counts")
            rows = counted.count()
            if not rows:
                break
            extend = _extension(spark, *_filter(counted, rows, filter_bits))
            relation = _next(relation, arrow_map(occurrences, extend, PHRASES))
            levels.append(materialize(_frequent_phrases(counted, relation, levels[-1]), "frequent"))
            remove(counted)
    remove(relation)

    found = None
    for length in range(2, len(levels) + 1):
        own = levels[length - 1]
        if length < len(levels):
            above = levels[length]
            inside = above.select(F.col("left").alias("phrase"), "a").unionByName(above.select(F.col("right").alias("phrase"), "a"))
            inside = inside.groupBy("phrase").agg(F.max("a").alias("longer"))
            own = own.join(inside, "phrase", "left").where(F.coalesce(100 * F.col("longer"), F.lit(0)) < covered_percent * F.col("a"))
        cut = own.join(totals, "lang").withColumn("cut", _weakest_cut(length))
        cut = cut.select("lang", F.col("phrase_text").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
        found = cut if found is None else found.unionByName(cut)
    if found is None:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if listed is not None:
        ranked = ranked.where(F.col("rank") <= listed)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
