"""Mixing sources to target weights with DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.shared import WORD
from sedimenta.scratch import materialize

#: Weights by rank of the source, repeating; the mix as a share of all words; epochs at most.
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
#: Rows of a source that one task orders, about.
BUCKET_ROWS = 2_000


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size, n_rows, target) from rows of (source, size).

    Targets share ``share_percent`` of all words by weight and stop at ``epochs`` times
    the source; what is over goes to the others by weight, until none is above. Sorted by
    size over weight the full sources come first, so each target follows from running
    sums over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * epochs)
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everyone) * F.lit(share_percent / 100.0)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    per = per.withColumn("level", level)
    # the level of the first source that stays under its cap holds from there on
    fits = F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("level"))
    held = F.first(fits, ignorenulls=True).over(by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.when(held.isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("weight") * held, F.col("cap").cast("double"))
    )
    return per.select("source", "source_size", "n_rows", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights=WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    epochs: int = MAX_EPOCHS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """How many words the mix takes of each document.

    ``docs`` has doc_id, source and text. Returns a row per input row: doc_id, source,
    size, source_size, target, taken. Within a source rows are ordered by md5(doc_id),
    doc_id, size. The mix takes the whole source as often as its target holds it, then
    rows in that order until the target's words are reached; the row at the border gives
    the words that are missing. So a source gives floor(target) words exactly.

    The order is dealt to ranges of the hash, several for a large source, so no task
    holds a source: sums per range, running sums over the ranges, and running sums within.

    Null text has size 0; a null source is one of its own, last by code point; a null
    doc_id hashes as empty text. Equal rows count each. No rows give no rows. Columns
    besides the three are ignored.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
    )
    sized = materialize(sized, "mixing")
    targets = source_targets(sized, weights, share_percent, epochs)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    parts = F.ceil(F.col("n_rows") / bucket_rows)
    # one row per source: joined by value, nulls equal
    placed = (
        sized.withColumn("key", key)
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("bucket", F.floor(place * parts / F.lit(float(1 << 32))))
    )
    counted = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = F.sum("words").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = counted.select(
        F.col("source").alias("of"), F.col("bucket").alias("at"), F.coalesce(earlier, F.lit(0)).alias("base")
    )
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    upto = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = placed.withColumn("upto", upto).join(
        ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))
    )
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target")) - F.col("times") * F.col("source_size")
    start = F.col("base") + F.col("upto") - F.col("size")
    extra = F.least(F.greatest(F.col("rest") - start, F.lit(0)), F.col("size"))
    return (
        ordered.withColumn("times", times.cast("long"))
        .withColumn("rest", rest.cast("long"))
        .withColumn("taken", (F.col("times") * F.col("size") + extra).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "taken")
    )


def _borders(amounts: DataFrame) -> DataFrame:
    """A row per source: how often it is taken whole, the last row in order that is taken
    once more, how many rows equal to that are so in full, and the words of one in part."""
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = amounts.select("source", times.alias("times"), _place("doc_id", "size").alias("place"), "size", "taken")
    rows = rows.withColumn("extra", F.col("taken") - F.col("times") * F.col("size"))
    last = rows.groupBy("source").agg(F.max("times").alias("times"), F.max(F.when(F.col("extra") > 0, F.col("place"))).alias("last"))
    last = last.withColumnsRenamed({"source": "of", "times": "whole"})
    at = rows.join(last, F.col("source").eqNullSafe(F.col("of")) & (F.col("place") == F.col("last")))
    at = at.groupBy("source").agg(
        F.count_if((F.col("extra") == F.col("size")) & (F.col("extra") > 0)).alias("full"),
        F.max(F.when(F.col("extra") < F.col("size"), F.col("extra"))).alias("part"),
    )
    joined = last.join(at, F.col("of").eqNullSafe(F.col("source")), "left")
    return joined.select("of", "whole", "last", F.coalesce("full", F.lit(0)).alias("full"), F.coalesce("part", F.lit(0)).alias("part"))


def _place(doc_id: str, size: str) -> Column:
    """Where a row stands in the order of its source."""
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.struct(key.alias("key"), F.coalesce(F.col(doc_id), F.lit(0)).alias("doc_id"), F.col(size).alias("size"))


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: each document as often as it is taken, in the columns of ``docs``.

    The one document at a source's border is cut after its last word taken. Where a source
    is cut is one short row, so every document knows by itself how often it is taken and
    no text moves. Only rows equal to the one at the border (in source, doc_id and size)
    are numbered, by their text.

    Null texts, and others without words, are not taken; null ids and sources are values of
    their own; equal rows count each; no rows give no rows. Columns may have any names.
    """
    amounts = materialize(mix_sources(docs, **parameters), "amounts")
    borders = materialize(_borders(amounts), "borders")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
    )
    rows = rows.join(borders, F.col("source").eqNullSafe(F.col("of")))
    at_last = F.coalesce(F.col("doc_id"), F.lit(0)) == F.coalesce(F.col("last.doc_id"), F.lit(0))
    sized = rows.withColumn("size", word_count(F.col("text")))
    place = _place("doc_id", "size")
    equal = F.coalesce(place == F.col("last"), F.lit(False))
    others = sized.where(~equal).withColumn("extra", F.when(place < F.col("last"), F.col("size")).otherwise(F.lit(0)))
    twins = rows.where(at_last).withColumn("size", word_count(F.col("text"))).where(equal)
    nth = F.row_number().over(Window.partitionBy("source").orderBy("text"))
    amount = F.when(nth <= F.col("full"), F.col("size")).when(nth == F.col("full") + 1, F.col("part")).otherwise(F.lit(0))
    taken = others.unionByName(twins.withColumn("extra", amount))
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), (F.col("whole") + (F.col("extra") == F.col("size")).cast("long")).cast("int")),
        F.array_repeat(F.col("extra"), ((F.col("extra") > 0) & (F.col("extra") < F.col("size"))).cast("int")),
    )
    taken = taken.where(F.col("size") > 0).select("row", "text", F.explode(copies).alias("cut"))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    text = F.when(F.col("cut") > 0, F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("cut"), F.lit(1)).cast("int")), ""))
    kept = {c: F.col("row").getField(c) for c in docs.columns}
    kept["text"] = F.coalesce(text, F.col("row").getField("text"))
    return taken.select(*[value.alias(name) for name, value in kept.items()])
