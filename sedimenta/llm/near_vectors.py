"""Near-duplicate vectors: sign hashing, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.components import connected_components
from sedimenta.llm.shared import arrow_map
from sedimenta.llm.topk import usable
from sedimenta.scratch import materialize

THRESHOLD = 0.98
#: Probability that a pair just at the threshold shares a bucket in some table.
RECALL = 0.999
#: Vectors of a bucket that one task compares; larger buckets are cut in blocks.
BLOCK = 2048
SEED = 20240607


def layout(largest: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits per table, about one bucket per vector of the largest label, and tables for the recall."""
    bits = min(60, max(8, math.ceil(math.log2(max(largest, 1)))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def _codes(v: np.ndarray, bits: int, tables: int) -> np.ndarray:
    planes = np.random.default_rng([SEED, v.shape[1]]).standard_normal((v.shape[1], bits * tables))
    signs = (v @ planes > 0).reshape(len(v), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def _local_roots(linked: np.ndarray) -> np.ndarray:
    """The first row that each row reaches in a symmetric adjacency matrix."""
    n = len(linked)
    root = np.arange(n)
    while True:
        low = np.where(linked, root[None, :], n).min(axis=1)
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows that come sorted by ``keys``, and the groups' bounds."""
    rest: list[pa.RecordBatch] = []

    def bounds(table: pa.Table) -> np.ndarray:
        change = np.zeros(max(table.num_rows - 1, 0), bool)
        for k in keys:
            column = table.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*rest, batch])
        at = bounds(table)
        if len(at) > 2:
            yield table.slice(0, int(at[-2])).combine_chunks(), at[:-1]
        rest = table.slice(int(at[-2])).to_batches()
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        yield table, bounds(table)


def near_duplicate_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row (vec_id, embedding, label).

    Rows with equal label and vector are one vector with a count. Each vector goes to one
    bucket per table, by the signs of its products with random planes; within a bucket all
    cosines are computed in double precision. A pair met in several tables counts in the
    first. A bucket of more than ``block`` vectors is cut in blocks and each pair of blocks
    is a group of its own, so no task grows with a bucket. Groups give, per vector, how
    many links it has there and one vector it is joined with, never pairs.

    Rows with null label, null id or unusable or zero vector link with nothing and keep
    their own id. Equal rows count each. No rows give no rows; further columns are ignored.
    """
    vec = F.transform("embedding", lambda x: x.cast("double"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("embedding"), F.col("label").cast("string").alias("label"))
    good = (
        usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
        & F.exists("embedding", lambda x: x != 0)
    )
    good = F.coalesce(good, F.lit(False))
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))  # -0 is 0
    vectors = rows.where(good).groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    vectors = materialize(vectors.withColumn("node", F.monotonically_increasing_id()), "vectors")
    largest = vectors.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = layout(largest, threshold, recall)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("embedding").offsets.to_numpy())
            for size in np.unique(lengths):
                part = batch.filter(pa.array(lengths == size))
                v = part.column("embedding").flatten().to_numpy().reshape(-1, size)
                with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                    v = v / np.abs(v).max(axis=1, keepdims=True)
                v = v / np.linalg.norm(v, axis=1, keepdims=True)
                codes = _codes(v, bits, tables)
                n = len(v)
                turn = np.tile(np.arange(n), tables)
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                body = pa.array([x.tobytes() for x in v], pa.binary())
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": part.column("label").take(pa.array(turn)),
                        "dim": pa.array(np.full(n * tables, size, np.int32)),
                        "tab": pa.array(np.repeat(np.arange(tables, dtype=np.int32), n)),
                        "code": pa.array(codes.T.ravel()),
                        "node": part.column("node").take(pa.array(turn)),
                        "copies": part.column("copies").take(pa.array(turn)),
                        "codes": packed.take(pa.array(turn)),
                        "vec": body.take(pa.array(turn)),
                    }
                )

    bucket = ["label", "dim", "tab", "code"]
    dealt = arrow_map(
        vectors, deal, "label string, dim int, tab int, code long, node long, copies long, codes binary, vec binary"
    )
    # how many blocks each bucket takes, from the codes alone
    large = dealt.groupBy(*bucket).count().where(F.col("count") > block)
    large = materialize(large.select(*bucket, F.ceil(F.col("count") / block).alias("blocks")), "buckets")
    dealt = dealt.join(large, bucket, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    group = F.xxhash64(*bucket, "low", "high")
    keys = ["grp", *bucket, "low", "high"]
    dealt = dealt.withColumn("grp", group).repartition("grp").sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, keys):
            node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            tab, dim = table.column("tab").to_numpy(), table.column("dim").to_numpy()
            low, high, own = (table.column(c).to_numpy() for c in ("low", "high", "own"))
            codes, vec = table.column("codes").chunk(0), table.column("vec").chunk(0)
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if b - a < 2:
                    continue
                v = np.frombuffer(b"".join(vec.slice(a, b - a).to_pylist()), float).reshape(b - a, dim[a])
                linked = v @ v.T >= threshold
                np.fill_diagonal(linked, False)
                if low[a] != high[a]:
                    linked &= own[a:b, None] != own[None, a:b]
                x, y = np.nonzero(linked)
                if not len(x):
                    continue
                root = _local_roots(linked)
                c = np.frombuffer(b"".join(codes.slice(a, b - a).to_pylist()), np.int64).reshape(b - a, tables)
                new = np.ones(len(x), bool)
                for t in range(tab[a]):
                    new &= c[x, t] != c[y, t]
                links = np.bincount(x[new], weights=copies[a:b][y[new]], minlength=b - a).astype(np.int64)
                has = np.flatnonzero(linked.any(axis=1))
                out[0].append(node[a:b][has])
                out[1].append(links[has])
                out[2].append(node[a:b][root[has]])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["node", "links", "root"])

    links = materialize(arrow_map(dealt, compare, "node long, links long, root long"), "links")
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    placed = vectors.join(counted, "node", "left").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(least, "root").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    same = ["label", "embedding"]
    joined = rows.where(good).join(placed, same).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
