"""What the learned scorers share: labelled samples and the columns they return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.shared import fold

#: Documents held out of learning: crc32(doc_id as text) mod FOLDS == HELD_OUT.
FOLDS, HELD_OUT = 3, 1
#: Labelled documents learned from at most.
SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of about ``rows`` labelled documents at most, none held out.

    Chosen by a hash of the id, so reruns agree. The ids fit in a broadcast by that bound.
    Null labels and ids are left out; of several labels of one id the largest counts.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    chosen = chosen.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    chosen = chosen.groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))
    total = chosen.count()
    share = min(1.0, rows / max(total, 1))
    chosen = chosen.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def with_prediction(scored: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
