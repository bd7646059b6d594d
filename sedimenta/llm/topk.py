"""Exact top-k inner products by sorted access alone (no random access)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_map, segments, text_batches
from sedimenta.scratch import materialize, remove

#: Scale of the integers, number of results, and which rows are queries.
SCALE = 256
TOP = 5
QUERY_STEP = 50
#: Most rows of a block of queries and of a block of candidates; vectors of over 64 components, fewer.
QUERY_BLOCK = 8192
CANDIDATE_BLOCK = 4096
#: Blocks that are cut at once from rows sorted by length.
BLOCKS_AT_ONCE = 8
#: Queries whose lists are read at a time, and pairs that are scored at a time.
QUERY_TILE = 512
PAIRS = 1 << 16
#: Queries of a task about, (query, row) pairs of a task about, and most parts of the candidates for that.
TASK_QUERIES = 1 << 18
TASK_PAIRS = 1 << 36
PARTS = 64

_LIMIT = (-(1 << 63), (1 << 63) - 1)
_rooms: dict[type, np.ndarray] = {}
_BLOCK = "dim int, width int, n long, asked long, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of ``x`` with the one row, or with each its own row, of ``q[0]``.

    Beyond 53 bits with Python's integers, held at 64.
    """
    q = np.broadcast_to(q[0], x.shape)
    out = np.einsum("ij,ij->i", q.astype(float), x.astype(float))
    wide = np.flatnonzero(_norms(q) * _norms(x) >= 1 << 52)
    if len(wide):
        s = (q[wide].astype(object) * x[wide].astype(object)).sum(axis=1)
        exact = out.astype(object)
        exact[wide] = np.clip(s, *_LIMIT)
        return exact.astype(np.int64)
    return out.astype(np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def _room(kind: type, m: int, n: int) -> np.ndarray:
    """Memory for m x n products, the same each time: fresh pages cost as much as what fills them."""
    if len(_rooms.get(kind, ())) < m * n:
        _rooms[kind] = np.empty(m * n, kind)
    return _rooms[kind][: m * n].reshape(m, n)


class _Lists:
    """The rows of a block as one list for each dimension: where the lists end, and what they hold."""

    def __init__(self, x: np.ndarray):
        self.rows = x
        self.norms = _norms(x)
        self.least, self.most = x.min(axis=0).astype(float), x.max(axis=0).astype(float)
        self._read: dict = {}

    def read(self, kind: type) -> np.ndarray:
        if kind not in self._read:
            self._read[kind] = np.ascontiguousarray(self.rows.T.astype(kind))
        return self._read[kind]


def _reach(q: np.ndarray, lists: _Lists, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (query, row) pairs that may be among the ``k`` best: their queries and rows."""
    norms, wide = _norms(q), q.astype(float)
    # what no row of the block can exceed: the ends of all lists, and the length of the longest row
    best = np.maximum(wide, 0) @ lists.most + np.minimum(wide, 0) @ lists.least
    best = np.clip(np.minimum(best, norms * lists.norms.max()), *_LIMIT)
    queries = np.flatnonzero(best + 1e-9 * np.abs(best) >= floor)
    if not len(queries):
        return queries, queries
    bound = float(norms[queries].max()) * float(lists.norms.max()) * (1 + 1e-9)
    # sums of integers under 24 or 53 bits in any order are exact
    kind = np.float32 if bound < 1 << 24 else np.float64
    upper = lower = np.matmul(q[queries].astype(kind), lists.read(kind), out=_room(kind, len(queries), len(lists.rows)))
    bar = floor[queries]
    if bound >= 1 << 52:
        slack = np.outer(norms[queries], lists.norms) * (len(q[0]) + 8) * 2.0**-52
        bar = bar - np.where(np.isfinite(bar), np.abs(bar), 0) * 2.0**-50
        upper, lower = np.clip(upper + slack, *_LIMIT), np.clip(lower - slack, *_LIMIT) * (1 - 2.0**-50)
    hit = np.flatnonzero(upper.max(axis=1) >= bar)
    queries, bar, n = queries[hit], bar[hit], len(lists.rows)
    if len(hit) < len(upper):
        upper, lower = upper[hit], lower[hit]
    over = upper >= bar.astype(kind)[:, None]
    many = np.flatnonzero(np.count_nonzero(over, axis=1) > 4 * k)
    if len(many):
        bar = np.maximum(bar[many], np.partition(lower[many], n - k, axis=1)[:, n - k])
        over[many] = upper[many] >= bar[:, None]
    at, rows = np.divmod(np.flatnonzero(over), n)
    return queries[at], rows


def survivors(q: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray) -> np.ndarray:
    """Which (query, row) pairs may be among the ``k`` best, by sorted access.

    Each dimension is a list of the block's rows. First only its ends are looked at: what the
    best ends together give, or the longest row does, bounds every pair of a query, and
    queries for which that is under ``floor`` (a k-th score known already) are done with the
    block. For those still open the lists are read to their ends, where lower and upper
    bounds meet (but for the rounding of scores beyond 52 bits). Pairs under ``floor`` are
    out, and of a query with many over it those under its k-th best lower bound.
    """
    alive = np.zeros((len(q), len(x)), bool)
    alive[_reach(q, _Lists(x), k, floor)] = True
    return alive


def _without_copies(ids: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal rows those with the ``most`` smallest ids: with ties to the smaller id, no query takes others."""
    odd = np.random.default_rng(1).integers(1 << 62, size=x.shape[1]) | 1
    hashes = (x.astype(np.int64) * odd).sum(axis=1)
    order = np.lexsort((ids, hashes))
    _, first, sizes = np.unique(hashes[order], return_index=True, return_counts=True)
    keep = np.ones(len(ids), bool)
    for at, n in zip(first[sizes > most], sizes[sizes > most], strict=True):
        run = order[at : at + n]
        if (x[run] == x[run[0]]).all():
            keep[run[most:]] = False
    return (ids, x) if keep.all() else (ids[keep], x[keep])


class _Best:
    """The k best of each query of one block, over the candidate blocks seen so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.sizes = np.zeros(len(ids), np.int64)
        self.scores = np.zeros((len(ids), k), np.int64)
        self.found = np.zeros((len(ids), k), np.int64)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.add_lists(ids, _Lists(x))

    def add_lists(self, ids: np.ndarray, lists: _Lists) -> None:
        for at in range(0, len(self.ids), QUERY_TILE):
            tile = slice(at, at + QUERY_TILE)
            floor = np.where(self.sizes[tile] == self.k, self.scores[tile, -1].astype(float), -np.inf)
            # a query is no candidate of its own, so one more may be needed of each block
            queries, rows = _reach(self.vectors[tile], lists, self.k + 1, floor)
            queries = queries + at
            other = ids[rows] != self.ids[queries]
            queries, rows = queries[other], rows[other]
            for i in range(0, len(rows), PAIRS):
                q, r = queries[i : i + PAIRS], rows[i : i + PAIRS]
                self._merge(q, _exact(self.vectors[q][None], lists.rows[r]), ids[r])

    def _merge(self, queries: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        now = np.unique(queries)
        held = np.arange(self.k) < self.sizes[now][:, None]
        q = np.concatenate([np.repeat(now, self.sizes[now]), queries])
        s = np.concatenate([self.scores[now][held], scores])
        f = np.concatenate([self.found[now][held], found])
        order = np.lexsort((f, ~s, q))
        q = q[order]
        starts = np.searchsorted(q, now)
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        best = place < self.k
        q, place, order = q[best], place[best], order[best]
        self.scores[q, place], self.found[q, place] = s[order], f[order]
        self.sizes[now] = np.bincount(np.searchsorted(now, q), minlength=len(now))

    def batch(self) -> pa.RecordBatch:
        held = np.arange(self.k) < self.sizes[:, None]
        return pa.RecordBatch.from_pydict(
            {"query_id": np.repeat(self.ids, self.sizes), "vec_id": self.found[held], "score": self.scores[held]}
        )


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the rows (vec_id, q) of each length."""
    n = pc.list_value_length(batch.column("q")).to_numpy(zero_copy_only=False)
    values, at = batch.column("q").flatten().to_numpy(zero_copy_only=False), segments(n)
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    for dim in np.unique(n).tolist():
        rows = np.flatnonzero(n == dim)
        yield ids[rows], values[at[rows][:, None] + np.arange(dim)]


def _unpacked(batch: pa.RecordBatch, row: int, dim: str, width: str, ids: str, vectors: str) -> tuple[np.ndarray, np.ndarray]:
    get = lambda c: batch.column(c)[row].as_py()
    return np.frombuffer(get(ids), np.int64), np.frombuffer(get(vectors), f"i{get(width)}").reshape(-1, get(dim))


def _pack(parts: Iterator[tuple[np.ndarray, np.ndarray]], most: int, step: int) -> Iterator[pa.RecordBatch]:
    """Rows, of one length in each part, as blocks of at most ``most``, the longest vectors first."""
    held: dict[int, list] = {}

    def cut(dim: int) -> Iterator[pa.RecordBatch]:
        ids, x = (np.concatenate(c) for c in zip(*held.pop(dim), strict=True))
        order = np.argsort(-_norms(x), kind="stable")
        n = rows(dim)
        for i in range(0, len(order), n):
            block, own = x[order[i : i + n]], ids[order[i : i + n]]
            low, high = int(block.min()), int(block.max())
            width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "width": pa.array([width], pa.int32()),
                "n": [len(own)], "asked": [int((own % step == 0).sum())],
                "ids": [own.astype(np.int64).tobytes()], "vectors": [block.astype(f"i{width}").tobytes()],
            })

    def rows(dim: int) -> int:
        return max(1, min(most, most * 64 // dim))

    for ids, x in parts:
        dim = x.shape[1]
        held.setdefault(dim, []).append((ids, x))
        if sum(len(i) for i, _ in held[dim]) >= BLOCKS_AT_ONCE * rows(dim):
            yield from cut(dim)
        if sum(x.size for c in held.values() for _, x in c) > 2 * BLOCKS_AT_ONCE * 64 * most:
            for d in list(held):
                yield from cut(d)
    for d in list(held):
        yield from cut(d)


def top_inner_products(
    rows: DataFrame, k: int = TOP, query_step: int = QUERY_STEP, scale: int = SCALE,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows, ties to the smaller id.

    ``rows`` has vec_id and embedding; components become floor(scale * x). Queries are the
    rows whose vec_id is divisible by ``query_step``, candidates all rows but the query's
    own. Both are packed in blocks where they lie. A task gets a part of the candidates and a
    share of the queries, as pairs of blocks, one to an Arrow batch; both are read from the
    packed tables, and candidates that lie in fewer files than there are parts are dealt out
    once. A task keeps each query's best so far, which raises the bar for the next block; per
    query and part of the candidates, of which there are 64 at most, k rows are merged.

    Null ids and unusable vectors take no part. Vectors are compared with those of equal
    length. Of rows with one vec_id the one with the smallest vector counts. A query with
    fewer than k candidates gets all; without candidates, no row. Other columns are ignored.
    """
    spark = rows.sparkSession
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q")).groupBy("vec_id").agg(F.min("q").alias("q"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack((part for batch in batches for part in _vectors(batch)), candidate_block, query_step)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def queries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, x = _unpacked(batch, i, "dim", "width", "ids", "vectors")
                    at = np.flatnonzero(ids % query_step == 0)
                    if len(at):
                        yield ids[at], x[at]

        return _pack(queries(), query_block, query_step)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests, now, ids, lists = {}, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                if (dim := get("dim")) != get("query_dim"):
                    continue
                if (key := (dim, get("ids")[:8])) != now:  # ids are unique, so the first one tells blocks apart
                    now = key
                    ids, x = _without_copies(*_unpacked(batch, i, "dim", "width", "ids", "vectors"), k + 1)
                    lists = _Lists(x)
                slot = dim, get("query_ids")[:8]
                if slot not in bests:
                    bests[slot] = _Best(*_unpacked(batch, i, "query_dim", "query_width", "query_ids", "queries"), k)
                bests[slot].add_lists(ids, lists)
        for best in bests.values():
            yield best.batch()

    with text_batches(spark, 2000):
        blocks = materialize(arrow_map(rows, pack, _BLOCK), "blocks")
    total, asked, count = blocks.agg(F.sum("n"), F.sum("asked"), F.count("*")).first()
    if not asked:
        remove(blocks)
        empty = "query_id long, rank int, vec_id long, score long"
        return spark.createDataFrame([], empty)
    shares = -(-asked // TASK_QUERIES)
    with text_batches(spark, 4):
        queries = materialize(arrow_map(blocks.where("asked > 0").coalesce(shares), ask, _BLOCK), "queries")
    tasks = max(total * asked // TASK_PAIRS, 2 * spark.sparkContext.defaultParallelism)
    parts = min(-(-tasks // shares), PARTS, count)
    candidates = blocks.select("dim", "width", "ids", "vectors")
    there = candidates.rdd.getNumPartitions()
    candidates = candidates.coalesce(parts) if there >= parts else candidates.repartition(parts)
    names = {"dim": "query_dim", "width": "query_width", "ids": "query_ids", "vectors": "queries"}
    pairs = candidates.crossJoin(queries.select([F.col(c).alias(n) for c, n in names.items()]))
    with text_batches(spark, 1):
        found = materialize(arrow_map(pairs, search, "query_id long, vec_id long, score long"), "found")
    remove(blocks)
    remove(queries)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
