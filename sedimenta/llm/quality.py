"""Quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.learning import SAMPLE_ROWS, labelled_sample, with_prediction
from sedimenta.llm.shared import arrow_map, hash_words, segments, slices, text_buffers

THRESHOLD = 0.5
#: Bins of a feature and, along each side, of a pair; pairs that get a table of their own.
BINS = 48
PAIR_BINS = 12
PAIRS = 10
ROUNDS = 200
PAIR_ROUNDS = 60
RATE = 0.1
#: Added to the curvature of a leaf; documents a leaf needs at least.
DAMPING = 2.0
LEAF_ROWS = 10

FEATURES = (
    "log_words", "word_length", "distinct_words", "repeated_next", "upper", "digits", "marks", "odd_marks",
    "bars", "exclamations", "above_ascii", "log_lines", "distinct_lines", "line_words", "full_stops", "commas",
    "long_words", "mark_words",
)
_UPPER, _LOWER, _DIGIT, _OTHER = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = _OTHER[128:] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = ~(_UPPER | _LOWER | _DIGIT | _OTHER | _SPACE)
_MARK[:32] = False
_ODD = _MARK.copy()
_ODD[[ord(c) for c in ".,;:!?'\"()-|"]] = False
_LINE = np.zeros(256, bool)
_LINE[[0x0A, 0x0D]] = True


def _distinct_share(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    both = np.unique(((hashes >> np.uint64(24)) | (row << np.uint64(40))) if len(counts) < 1 << 24 else hashes)
    return np.bincount((both >> np.uint64(40)).astype(np.int64), minlength=len(counts)) / np.maximum(counts, 1)


def measure(column: pa.Array) -> np.ndarray:
    """A row of FEATURES per text. Shares of an empty text are 0."""
    raw, offsets = text_buffers(column)
    size = np.maximum(np.diff(offsets), 1)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(segments(mask)[offsets])

    def share(table: np.ndarray) -> np.ndarray:
        return count(table[raw]) / size

    words, n = hash_words(raw, offsets)
    at = segments(n)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[at[:-1][n > 0]] = False
    lines, n_lines = hash_words(raw, offsets, _LINE)
    head = ~_SPACE[raw]
    tail = head.copy()
    head[1:] &= _SPACE[raw[:-1]]
    starts = np.zeros(len(raw) + 1, bool)
    starts[offsets] = True
    head |= starts[:-1] & ~_SPACE[raw]
    tail[:-1] &= _SPACE[raw[1:]] | starts[1:-1]
    begin, end = np.flatnonzero(head), np.flatnonzero(tail)
    per_word = np.maximum(n, 1)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.diff(segments(mask)[at]) / per_word

    only = lambda c: (raw == ord(c))
    return np.column_stack(
        [
            np.log1p(n), (size - count(_SPACE[raw])) / per_word, _distinct_share(words, n),
            np.diff(segments(same)[at]) / per_word, share(_UPPER), share(_DIGIT), share(_MARK), share(_ODD),
            count(only("|")) / size, count(only("!")) / size, share(_OTHER), np.log1p(n_lines),
            _distinct_share(lines, n_lines), n / np.maximum(n_lines, 1), count(only(".")) / per_word,
            count(only(",")) / per_word, of_words(end - begin >= 14), of_words(_MARK[raw[begin]]),
        ]
    ).astype(float)


@dataclass
class Additive:
    """bias + a table value per feature's bin + one per bin of each chosen pair."""

    bias: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edge, x[:, j], side="left")]
        for i, j, table in self.pairs:
            a, b = (np.searchsorted(self.coarse[k], x[:, k], side="left") for k in (i, j))
            out += table[a, b]
        return out


def _step(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """A shallow tree over ordered bins, as a value per bin: each split takes the largest gain."""
    value = np.full(len(g), -g.sum() / (h.sum() + DAMPING))
    if depth == 0 or len(g) < 2:
        return value
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = gl**2 / (hl + DAMPING) + (g.sum() - gl) ** 2 / (h.sum() - hl + DAMPING)
    gain[(nl < LEAF_ROWS) | (n.sum() - nl < LEAF_ROWS)] = -1
    cut = int(gain.argmax())
    if gain[cut] <= g.sum() ** 2 / (h.sum() + DAMPING):
        return value
    cut += 1
    return np.concatenate([_step(g[:cut], h[:cut], n[:cut], depth - 1), _step(g[cut:], h[cut:], n[cut:], depth - 1)])


def _pair_step(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of a split of one feature and one of the other in each half; its gain."""
    best, gain = None, 0.0
    for turned in (False, True):
        a, b, c = (x.T if turned else x for x in (g, h, n))
        for cut in range(1, len(a)):
            halves = [_step(x[0], x[1], x[2], 1) for x in ((a[:cut].sum(0), b[:cut].sum(0), c[:cut].sum(0)), (a[cut:].sum(0), b[cut:].sum(0), c[cut:].sum(0)))]
            value = np.concatenate([np.tile(halves[0], (cut, 1)), np.tile(halves[1], (len(a) - cut, 1))])
            now = -(a * value + 0.5 * (b * value**2)).sum()
            if now > gain:
                best, gain = (value.T if turned else value), now
    return (np.zeros_like(g) if best is None else best), gain


def train(x: np.ndarray, label: np.ndarray) -> Additive:
    """Cyclic boosting: every round gives each feature in turn one shallow tree, then pairs."""
    cuts = lambda v, bins: np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))
    share = (label.sum() + 1) / (len(label) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    model.edges = [cuts(v, BINS) for v in x.T]
    model.coarse = [cuts(v, PAIR_BINS) for v in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if label.min(initial=1) == label.max(initial=0) or not len(label):
        return model
    bins = [np.searchsorted(e, v, side="left") for e, v in zip(model.edges, x.T)]
    size = [len(e) + 1 for e in model.edges]
    rows = [np.bincount(b, minlength=k) for b, k in zip(bins, size)]
    logit = np.full(len(x), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return p - label, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = slopes()
            move = RATE * _step(np.bincount(b, g, size[j]), np.bincount(b, h, size[j]), rows[j], 2)
            model.tables[j] += move
            logit += move[b]
    bins = [np.searchsorted(e, v, side="left") for e, v in zip(model.coarse, x.T)]
    size = [len(e) + 1 for e in model.coarse]

    def grid(i: int, j: int, weights: np.ndarray | None) -> np.ndarray:
        return np.bincount(bins[i] * size[j] + bins[j], weights, size[i] * size[j]).reshape(size[i], size[j])

    g, h = slopes()
    gains = [(-_pair_step(grid(i, j, g), grid(i, j, h), grid(i, j, None))[1], i, j) for i, j in combinations(range(x.shape[1]), 2)]
    model.pairs = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in sorted(gains)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h = slopes()
            move = RATE * _pair_step(grid(i, j, g), grid(i, j, h), grid(i, j, None))[0]
            table += move
            logit += move[bins[i], bins[j]]
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Additive:
    """Learn from at most about ``rows`` labelled documents; the driver gets their features."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = measure(batch.column(0))
            yield pa.RecordBatch.from_pydict({"label": batch.column(1), "x": pa.array([r.tobytes() for r in x], pa.binary())})

    got = arrow_map(labelled_sample(docs, labels, "quality", rows), features, "label int, x binary").toArrow()
    got = got.sort_by([("label", "ascending"), ("x", "ascending")])
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), float).reshape(-1, len(FEATURES))
    if not len(x):
        return Additive(0.0)
    return train(x, (got.column("label").to_numpy() > 0).astype(float))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id and score, 0 to 1; whole texts, nulls as empty."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            logit = model.logits(measure(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], names=["doc_id", "score"]
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), apply, "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only text is scored; ids and labels choose what is learned from. Null text is empty.
    Null ids are never learned from. Without labels every score is a half; with labels of
    one kind only, their smoothed share. Empty tables give no rows. Further columns are
    ignored.
    """
    return with_prediction(score(docs, fit(docs, labels)), THRESHOLD)
