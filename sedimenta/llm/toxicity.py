"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.learning import SAMPLE_ROWS, labelled_sample, with_prediction
from sedimenta.llm.shared import arrow_map, segments, slices, text_buffers, word_blocks

THRESHOLD = 0.7
#: Hash buckets of terms; buckets that the machine learns of; factors of each.
BUCKETS = 1 << 20
ACTIVE = 4096
FACTORS = 8
#: Bytes of the word beginnings that count as terms besides the word.
PREFIXES = (4, 5, 6, 7, 8)
#: Least likelihood-ratio statistic of a bucket that takes part.
EVIDENCE = 20.0
EPOCHS = 300
#: Shrinkage of the weights.
SHRINK = 2e-4
SEED = 11

# words are runs of ASCII letters and digits and of anything above ASCII
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _share(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Machine:
    """bias + sum of w_i x_i + sum of <v_i, v_j> x_i x_j over the terms of a document.

    ``slot`` gives a bucket's place in ``linear`` and ``factors``, or -1.
    """

    slot: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(row, self.linear[term], n)
        for f in self.factors.T:
            v = f[term]
            out += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return out


def distinct_terms(column: pa.Array, slot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct hashed terms of each text, sorted; with ``slot`` only
    the known ones, as their places. A term is a lower-cased word or a word's beginning."""
    raw, offsets = text_buffers(column)
    rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, e, spans, at in word_blocks(raw, offsets, _APART):
        for size in (0, *PREFIXES):
            a = s[e - s > size]
            bucket = (spans(a, a + size if size else e) ^ np.uint64(size)) >> np.uint64(44)
            bucket = bucket.astype(np.int64)
            if slot is not None:
                bucket = slot[bucket]
                a, bucket = a[bucket >= 0], bucket[bucket >= 0]
            rows.append(np.searchsorted(offsets, a + at, side="right") - 1)
            terms.append(bucket)
    pairs = np.unique((np.concatenate(rows) << 20) | np.concatenate(terms))
    return pairs >> 20, pairs & (BUCKETS - 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task: for each bucket, how many documents of either label have it."""
    with_label = np.zeros((2, BUCKETS), np.int64)
    for batch in slices(batches):
        row, bucket = distinct_terms(batch.column(0))
        label = batch.column(1).to_numpy()[row]
        for k in (0, 1):
            with_label[k] += np.bincount(bucket[(label > 0) == bool(k)], minlength=BUCKETS)
    at = np.flatnonzero(with_label.any(axis=0))
    yield pa.RecordBatch.from_pydict({"bucket": at, "clean": with_label[0, at], "toxic": with_label[1, at]})


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, active: int = ACTIVE) -> Machine:
    """Learn from at most about ``rows`` labelled documents.

    Buckets are counted by label over the sample; the ``active`` ones that tell the labels
    apart best take part. What the driver gets is bounded by ``active`` and ``rows``.
    Without labels of both kinds the score is the smoothed share of toxic labels.
    """
    sample = labelled_sample(docs, labels, "toxic", rows)
    totals = sample.agg(F.count_if(F.expr("label > 0")), F.count_if(F.expr("label <= 0"))).first()
    toxic, clean = int(totals[0]), int(totals[1])
    machine = Machine(
        np.full(BUCKETS, -1, np.int32), float(np.log((toxic + 1) / (clean + 1))), np.zeros(0), np.zeros((0, FACTORS))
    )
    if not toxic or not clean:
        return machine
    counted = arrow_map(sample, _counts, "bucket long, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # the likelihood-ratio statistic of a bucket's counts against the labels' shares
    both = F.col("toxic") + F.col("clean")
    parts = [F.col(c) * F.log(F.greatest(F.col(c), F.lit(1)) / (both * n / (toxic + clean))) for c, n in (("toxic", toxic), ("clean", clean))]
    strength = 2 * (parts[0] + parts[1])
    best = counted.withColumn("strength", strength).where(F.col("strength") >= EVIDENCE)
    best = best.orderBy(F.desc("strength"), "bucket").limit(active).select("bucket")
    buckets = np.sort(np.array([r[0] for r in best.collect()], np.int64))
    machine.slot[buckets] = np.arange(len(buckets))
    slot = machine.slot

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, term = distinct_terms(batch.column(0), slot)
            at = segments(np.bincount(row, minlength=batch.num_rows))
            terms = [term[a:b].astype(np.int32).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_pydict({"label": batch.column(1), "terms": pa.array(terms, pa.binary())})

    got = arrow_map(sample, known, "label int, terms binary").toArrow().sort_by([("label", "ascending"), ("terms", "ascending")])
    terms = [np.frombuffer(t, np.int32) for t in got.column("terms").to_pylist()]
    label = (got.column("label").to_numpy() > 0).astype(float)
    return train(machine, np.repeat(np.arange(len(terms)), [len(t) for t in terms]), np.concatenate(terms), label, len(buckets))


def train(machine: Machine, row: np.ndarray, term: np.ndarray, label: np.ndarray, size: int) -> Machine:
    """Full-batch Adam on the logistic loss with both weights shrunk."""
    n, rng = len(label), np.random.default_rng(SEED)
    theta = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.02, (size, FACTORS))], axis=1)
    bias, m, v, mb, vb = machine.bias, np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    for step in range(1, EPOCHS + 1):
        machine.bias, machine.linear, machine.factors = bias, theta[:, 0], theta[:, 1:]
        wrong = _share(machine.logits(row, term, n)) - label
        grad = np.empty_like(theta)
        pull = wrong[row]
        grad[:, 0] = np.bincount(term, pull, size)
        for f in range(FACTORS):
            own = theta[term, 1 + f]
            grad[:, 1 + f] = np.bincount(term, pull * (np.bincount(row, own, n)[row] - own), size)
        grad = grad / n + SHRINK * theta
        gb = wrong.mean()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.99**step
        theta = theta - 0.05 * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias = bias - 0.05 * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    machine.bias, machine.linear, machine.factors = float(bias), theta[:, 0], theta[:, 1:]
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id and score, 0 to 1; whole texts, nulls as empty."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, term = distinct_terms(batch.column(1), machine.slot)
            logit = machine.logits(row, term, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_share(logit))], names=["doc_id", "score"]
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), apply, "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only text is scored; ids and labels choose what is learned from. Empty and null texts
    get the machine's bias. Null ids are never learned from. Equal rows score alike. Empty
    tables give no rows. Further columns are ignored.
    """
    return with_prediction(score(docs, fit(docs, labels)), THRESHOLD)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns as they are."""
    machine, place = fit(docs, labels), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, term = distinct_terms(batch.column(place), machine.slot)
            yield batch.filter(pa.array(_share(machine.logits(row, term, batch.num_rows)) < threshold))

    return arrow_map(docs, keep, docs.schema)
