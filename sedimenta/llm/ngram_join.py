"""Exact Jaccard self-join of documents on word shingles, as a metric-space join.

1. A document is the set of its shingles; documents with equal sets are one node.
2. *Pivots of parts*. If |x ^ y| <= H and the shingle universe is cut in more than H parts
   by hash, x and y agree in some part: both lie at projected distance 0 from that part's
   content. Of the nodes that share a part's content the first one is the pivot; its region
   holds all of them, so any two nodes that may link meet in a region.
3. *Sketches*. A set's sketch holds the parity of its members by hash bucket. Two sketches
   differ in at most |x ^ y| buckets, so what differs in more cannot link. A region shrinks to
   the groups of nodes that sketches leave together; equal groups of several regions are one.
4. *Joining regions*. A node first goes to its smallest pivot only, which joins most copies;
   then regions whose nodes are not all joined by now are joined in full. Only nodes left
   by the sketches have their sets fetched. A small region is joined exactly in one task.
5. *Voronoi cells*. In a large region Jaccard distance 1 - J is a metric that tells nodes
   apart. Nodes of it are chosen as pivots; each node goes to its nearest one. What is under
   another label than most of the region goes as well to every other cell that could hold a
   partner by the triangle inequality. Cells are regions again. Near copies lie in the windows
   of all cells: where blocks take fewer rows than cells, a region is joined block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.components import connected_components
from sedimenta.llm.near_vectors import whole_groups
from sedimenta.llm.shared import arrow_map, hash_words, mix, release, segments, slices, text_batches, text_buffers
from sedimenta.scratch import materialize

WIDTH, PERCENT = 4, 85
#: Nodes, and shingles, that one task joins at a time; pivots of a larger region.
LEAF_NODES = 4000
LEAF_SHINGLES = 2_000_000
PIVOTS = 32
#: Nodes, and shingles, of a region whose sketches one task compares; at least this many bits each.
SKETCH_NODES = 4000
SKETCH_SHINGLES = 20_000_000
SKETCH_BITS = 256
#: Bits, at most, of the sketches that one task draws of the sets it joins.
LEAF_BITS = 4096
#: Rows of an Arrow batch, and of one whose rows come with their pivots' sets; bytes of one.
BATCH_ROWS, PLACED_ROWS = 2000, 64
BATCH_BYTES = 16 << 20
#: Narrow rows, of regions (region, node, label) or ids, that are sent to every task at most.
BROADCAST_ROWS = 500_000
#: Times a region is cut by pivots; what is still large then is joined block by block.
DEPTH = 3

_STEP = np.uint64(0x9FB21C651E98DF25)
_LADDER = sorted({k for i in range(31) for k in (1 << i, 3 << i) if k >= 3})


def shingle_sets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending per text, and their numbers."""
    raw, offsets = text_buffers(column)
    words, n = hash_words(raw, offsets)
    at = segments(n)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    start = np.repeat(at[:-1], count) + np.arange(count.sum()) - np.repeat(segments(count)[:-1], count)
    row = np.repeat(np.arange(len(n)), count)
    size = np.minimum(n, width)[row]
    out = size.astype(np.uint64)
    for k in range(width):
        use = size > k
        out[use] = out[use] * _STEP + words[start[use] + k]
    out = mix(out)
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[keep], np.bincount(row[keep], minlength=len(n))


def node_ids(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 63-bit identity of each set."""
    at = segments(counts)
    total = np.zeros(len(counts), np.uint64)
    some = counts > 0
    if some.any():
        total[some] = np.add.reduceat(mix(hashes ^ _STEP), at[:-1][some])
    return (mix(total + counts.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


def sketches(hashes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A parity bit per hash bucket of each set, with about as many buckets as members.

    Buckets are the low bits of a hash: halves of a sketch, folded by exclusive or, are the
    sketch of half as many buckets.
    """
    bits = _sketch_bits(counts)
    at = segments(bits)
    place = np.repeat(at[:-1], counts) + (hashes & (np.repeat(bits, counts) - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(place, minlength=at[-1]) & 1).astype(bool), bitorder="little").tobytes()
    return [odd[a // 8 : b // 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _sketch_bits(n: np.ndarray | float) -> np.ndarray:
    return 2 ** np.ceil(np.log2(np.maximum(n, SKETCH_BITS))).astype(np.int64)


def _folded(sketch: np.ndarray, width: int) -> np.ndarray:
    while sketch.shape[1] > width:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def look_alikes(packed: list[bytes], n: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """Groups of sets that may link under different labels, by number; -1: no such partner."""
    bits = _sketch_bits(n)
    group = np.arange(len(n))
    some = np.zeros(len(n), bool)
    levels = {int(b): np.flatnonzero(bits == b) for b in np.unique(bits)}
    whole = {b: np.frombuffer(b"".join([packed[i] for i in own]), np.uint64).reshape(len(own), -1) for b, own in levels.items()}
    for low, own in levels.items():
        for high, other in levels.items():
            if high < low or n[other].min() * percent > 100 * n[own].max():
                continue
            theirs = _folded(whole[high], low // 64)
            step = max(1, (1 << 20) // theirs.size)
            for s in range(0, len(own), step):
                mine = own[s : s + step]
                apart = np.bitwise_count(whole[low][s : s + step, None] ^ theirs[None]).sum(axis=2, dtype=np.int64)
                total = n[mine, None] + n[None, other]
                near = apart * (100 + percent) <= (100 - percent) * total
                near &= label[mine, None] != label[None, other]
                for i in np.flatnonzero(near.any(axis=1)).tolist():
                    met = np.append(other[near[i]], mine[i])
                    some[met] = True
                    ids = np.unique(group[met])
                    if len(ids) > 1:
                        group[np.isin(group, ids)] = ids[0]
    return np.where(some, group, -1)


def _parts(n: np.ndarray, percent: int) -> np.ndarray:
    """In how many parts the universe is cut for pairs whose smaller set has n members: a
    tenth more than the pigeonhole needs, rounded up to a few sizes; 1: only equal sets link."""
    top = int(n.max(initial=0))
    need = (100 - percent) * (n + n * 100 // percent) // (100 + percent)
    want = np.ceil(1.1 * (need + 1))
    ladder = np.array([k for k in _LADDER if k <= 4 * top + 8] or [3])
    return np.where(need == 0, 1, ladder[np.minimum(np.searchsorted(ladder, want), len(ladder) - 1)])


def part_keys(hashes: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the contents of every part of every set.

    A set takes part with the cut of every size its smaller partner may have. Empty parts
    count only for sets with so many of them that all parts shared with a partner could be
    empty; a partner for which that holds emits them too.
    """
    low, high = _parts(np.maximum(-(-counts * percent // 100), 1), percent), _parts(np.maximum(counts, 1), percent)
    row = np.repeat(np.arange(len(counts)), counts)
    body = mix(hashes ^ np.uint64(0xA0761D6478BD642F))
    rows, keys = [], []
    for cut in np.union1d(np.unique(low), np.unique(high)):
        if cut == 1:
            continue
        use = (low <= cut) & (cut <= high) & (counts > 0)
        inside = use[row]
        r = row[inside]
        if not len(r):
            continue
        part = ((hashes[inside] >> np.uint64(32)) * np.uint64(cut)) >> np.uint64(32)
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        tag = mix((np.uint64(cut) << np.uint64(32)) + part[first])
        rows.append(r[first])
        keys.append(mix(np.add.reduceat(body[inside], first) ^ tag))
        filled = np.bincount(r[first], minlength=len(counts))
        most = math.floor(cut / 1.1 + 1e-9) - 1  # the largest difference this cut serves
        for i in np.flatnonzero(use & (cut - filled >= cut - most)).tolist():
            empty = np.setdiff1d(np.arange(cut, dtype=np.uint64), part[first][r[first] == i])
            rows.append(np.full(len(empty), i))
            keys.append(mix(~mix((np.uint64(cut) << np.uint64(32)) + empty)))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none.astype(np.uint64), *keys])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and node: (first node of a key, other node) of all keys."""
    last, head = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        new[0] = key[0] != last
        place = np.cumsum(new)
        heads = np.concatenate([[head if head is not None else node[0]], node[new]])[place]
        other = heads != node
        pairs = np.unique(np.column_stack([heads[other], node[other]]), axis=0)
        last, head = key[-1], heads[-1]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _linked(shared: np.ndarray, n: np.ndarray, m: int, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (n + m - shared)


def local_join(sets: list[np.ndarray], label: np.ndarray, percent: int) -> np.ndarray:
    """Components of the sets, exactly, beyond those that ``label`` gives.

    Each set outside the largest component is compared with all under other labels that their
    sketches do not rule out. Of two sets that neither were compared both are in the largest one.
    """
    n = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(ids, np.cumsum(n)[:-1])
    label = np.unique(label, return_inverse=True)[1]
    drawn = _drawn(ids, n)
    mark = np.zeros(ids.max(initial=0) + 1, bool)
    todo = np.ones(len(sets), bool)
    while True:
        outside = todo & (label != np.bincount(label).argmax())
        if not outside.any():
            return label
        i = int(outside.argmax())
        todo[i] = False
        apart = np.bitwise_count(drawn ^ drawn[i]).sum(axis=1, dtype=np.int64)
        other = np.flatnonzero((apart * (100 + percent) <= (100 - percent) * (n + n[i])) & (label != label[i]))
        if not len(other):
            continue
        mark[own[i]] = True
        shared = np.array([np.count_nonzero(mark[own[j]]) for j in other.tolist()])
        mark[own[i]] = False
        near = other[_linked(shared, n[other], n[i], percent)]
        label[np.isin(label, label[near])] = label[i]


def _drawn(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sketches of sets of numbers from 0, all of one width."""
    bits = int(min(_sketch_bits(np.mean(n)), LEAF_BITS))
    place = np.repeat(np.arange(len(n)) * bits, n) + ids % bits
    odd = (np.bincount(place, minlength=len(n) * bits) & 1).astype(bool)
    return np.packbits(odd).view(np.uint64).reshape(len(n), -1)


def _join_leaves(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["region"]):
            node, body = table.column("node").to_numpy(), table.column("shingles").combine_chunks()
            label = table.column("label").to_numpy()
            a, b = [], []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                if e - s < 2:
                    continue
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in body[s:e]]
                found = local_join(sets, label[s:e], percent)
                # one edge for each label that another one is joined to
                _, first = np.unique(label[s:e], return_index=True)
                _, heads, which = np.unique(found[first], return_index=True, return_inverse=True)
                head = first[heads[which]]
                new = first != head
                a.append(node[s:e][first[new]])
                b.append(node[s:e][head[new]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _look_alikes(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["region"]):
            node, n, label = (table.column(c).to_numpy() for c in ("node", "n", "label"))
            region, keep = np.zeros(len(node), np.uint64), np.zeros(len(node), bool)
            for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                group = look_alikes(table.column("sketch")[s:e].to_pylist(), n[s:e], label[s:e], percent)
                some = np.flatnonzero(group >= 0)
                keep[s + some] = True
                # named by its members, so that other regions' equal groups have the same name
                names = np.zeros(e - s, np.uint64)
                np.add.at(names, group[some], mix(node[s:e][some].view(np.uint64) ^ _STEP))
                region[s + some] = mix(names[group[some]])
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.view(np.int64)[keep])] + [pa.array(c[keep]) for c in (node, n, label)],
                    names=["region", "node", "n", "label"],
                )

    return run


_NARROW = "region long, node long, n long, label long"
_PLACED = "region long, node long, n long, label long, home int, windows array<int>, links array<long>"


def _place(percent: int):
    """Distances of each node to its region's pivots: home, windows, and pivots it links with.

    Cell -1 is for what is far from all pivots. Nodes may go to it, not from it to others.
    """
    near = 1 - percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes, windows, links, joined = [], [], [], set()
            seen: dict[int, tuple] = {}
            for i in range(batch.num_rows):
                region = batch.column("region")[i].as_py()
                if region not in seen:
                    seen = {region: [(p["node"], np.frombuffer(p["shingles"], np.uint64)) for p in batch.column("pivots")[i].as_py()]}
                own = np.frombuffer(batch.column("shingles")[i].as_py(), np.uint64)
                far, link = [], []
                for pivot, members in seen[region]:
                    both = len(np.intersect1d(own, members, assume_unique=True))
                    far.append(1 - both / (len(own) + len(members) - both))
                    if _linked(np.array(both), np.array(len(own)), len(members), percent):
                        link.append(pivot)
                least = min(far)
                home = far.index(least) if least <= 1 - near else -1
                window = [j for j in range(len(far)) if home not in (-1, j) and far[j] <= least + 2 * near + 1e-9]
                if home >= 0 and least > 1 - 2 * near - 1e-9:
                    window.append(-1)
                homes.append(home)
                windows.append(window)
                # one edge to the first pivot, and what first tells that two pivots are joined
                new = [p for p in link[1:] if (link[0], p) not in joined]
                joined.update((link[0], p) for p in new)
                links.append(link[:1] + new)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("region", "node", "n", "label")]
                + [pa.array(homes, pa.int32()), pa.array(windows, pa.list_(pa.int32())), pa.array(links, pa.list_(pa.int64()))],
                names=["region", "node", "n", "label", "home", "windows", "links"],
            )

    return run


def _sized(rows: DataFrame, most_nodes: int | None = None, most_shingles: int | None = None) -> DataFrame:
    """Regions with more than one label, and whether one task can join them."""
    most_nodes, most_shingles = most_nodes or LEAF_NODES, most_shingles or LEAF_SHINGLES
    sizes = rows.groupBy("region").agg(
        F.count("*").alias("nodes"), F.sum("n").alias("total"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    leaf = (F.col("nodes") <= most_nodes) & (F.col("total") <= most_shingles)
    return sizes.where("low <> high").select("region", "nodes", "total", leaf.alias("leaf"))


def _cut(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One Voronoi cut of large regions: cells, blocks of regions where these take fewer rows,
    both without sets, and the links met."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("node", "region"), "node")
    chosen = rows.select("region", "node").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PIVOTS)
    pivots = rows.join(chosen, ["region", "node"]).groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct("nth", "node", "shingles"))).alias("pivots")
    )
    placed = arrow_map(rows.join(pivots, "region"), _place(percent), _PLACED)
    # every row comes with its region's pivots
    with text_batches(rows.sparkSession, PLACED_ROWS):
        placed = materialize(placed, "placed")
    met = placed.select(F.col("node").alias("a"), F.explode("links").alias("b"))
    # join what was joined before, too, and label every node anew
    before = placed.select(F.col("node").alias("a"), F.col("label").alias("b"))
    roots = connected_components(met.unionByName(before))
    placed = placed.drop("label").join(roots.withColumnRenamed("root", "label"), "node", "left")
    placed = placed.withColumn("label", F.coalesce("label", "node"))
    placed = placed.select("region", "node", "n", "label", "home", "windows")
    placed = materialize(placed.join(_cores(placed).select("region", "core"), "region"), "labelled")
    cells = placed.groupBy("region", "home").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    own = placed.select("region", "node", "n", "label", F.col("home").alias("cell"))
    # pairs within the commonest label are joined already: the others go both ways
    window = F.when(F.col("label") != F.col("core"), F.col("windows")).otherwise(F.filter("windows", lambda w: w < 0))
    guests = placed.select("region", "node", "n", "label", F.explode(window).alias("cell"))
    # a guest is needed only where nodes of another component are at home
    guests = guests.join(cells.withColumnRenamed("home", "cell"), ["region", "cell"])
    guests = guests.where("low <> label OR high <> label").drop("low", "high")
    parts = materialize(own.unionByName(guests.select(*own.columns)), "cells")
    in_cells = parts.groupBy("region").agg(F.count("*").alias("in_cells"))
    narrow = placed.select("region", "node", "n", "label")
    sizes = _block_sizes(narrow).join(in_cells, "region")
    by_cell = sizes.where("in_cells <= in_blocks").select("region")
    blocks = _blocks(narrow, sizes.where("in_cells > in_blocks"))
    parts = parts.join(by_cell, "region")
    return parts.select(F.xxhash64("region", "cell").alias("region"), "node", "n", "label"), blocks, met


def _cores(rows: DataFrame) -> DataFrame:
    """(region, core): the commonest label of each region, and what is not under it."""
    counted = rows.groupBy("region", "label").agg(F.count("*").alias("nodes"), F.sum("n").alias("total"))
    core = counted.groupBy("region").agg(
        F.max(F.struct("nodes", "label", "total")).alias("core"), F.sum("nodes").alias("nodes"), F.sum("total").alias("total")
    )
    return core.select(
        "region", F.col("core.label").alias("core"), "nodes", "total",
        (F.col("nodes") - F.col("core.nodes")).alias("others"), (F.col("total") - F.col("core.total")).alias("others_total"),
    )


def _block_sizes(rows: DataFrame, most_nodes: int | None = None, most_shingles: int | None = None) -> DataFrame:
    """How many blocks the regions are cut in, and ``in_blocks``: rows that this makes.

    Blocks of all nodes meet blocks of those not under the commonest label (``turns``), or each
    other (0 turns) if that takes no more rows.
    """
    most_nodes, most_shingles = most_nodes or LEAF_NODES, most_shingles or LEAF_SHINGLES

    def halves(nodes: str, total: str):
        return F.greatest(F.ceil(F.col(nodes) * 2 / most_nodes), F.ceil(F.col(total) * 2 / most_shingles), F.lit(1))

    sizes = _cores(rows).withColumn("blocks", halves("nodes", "total")).withColumn("turns", halves("others", "others_total"))
    every, some = F.col("nodes") * F.col("blocks"), F.col("others") * F.col("blocks") + F.col("nodes") * F.col("turns")
    return sizes.select(
        "region", "core", "blocks", F.when(some < every, F.col("turns")).otherwise(0).alias("turns"), F.least(every, some).alias("in_blocks")
    )


def _blocks(
    rows: DataFrame, sizes: DataFrame, most_nodes: int | None = None, most_shingles: int | None = None
) -> DataFrame:
    """Every pair of blocks of a large region, but for pairs within its commonest label, as a
    region of its own."""
    rows = rows.join(sizes.select("region"), "region", "left_semi")
    rows = rows.join(_block_sizes(rows, most_nodes, most_shingles), "region")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("turn", F.pmod(F.xxhash64("node", F.lit(1)), F.greatest("turns", F.lit(1))))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.greatest(F.col(n), F.lit(1)) - 1)
    every = F.transform(upto("blocks"), lambda k: F.struct(F.least("own", k).alias("x"), F.greatest("own", k).alias("y")))
    met = F.transform(upto("turns"), lambda k: F.struct(k.alias("x"), F.col("own").alias("y")))
    meets = F.transform(upto("blocks"), lambda k: F.struct(F.col("turn").alias("x"), k.alias("y")))
    meets = F.when(F.col("label") != F.col("core"), F.array_union(met, meets)).otherwise(met)
    pairs = F.explode(F.when(F.col("turns") > 0, meets).otherwise(every)).alias("pair")
    rows = rows.select("region", "node", "n", "label", pairs)
    return rows.select(F.xxhash64("region", "pair.x", "pair.y").alias("region"), "node", "n", "label")


def similar_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs`` (doc_id, text).

    Words are what lies between ASCII white space, A-Z lower-cased. A set holds the
    distinct shingles of ``width`` words, or the whole sequence of fewer. Documents link
    when 100 * intersection >= percent * union; no link between unlike sets is lost, and
    ``component_id`` is the smallest doc_id reachable. Shingles are 64-bit hashes.

    Texts without words (null, empty, blank) have 0 shingles and link with nothing. Rows
    with one doc_id count each, as linked or not as their texts say. A null doc_id can be
    linked but names no component unless all are null. No rows give no rows; further
    columns are ignored.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH_BYTES))
    try:
        with text_batches(docs.sparkSession, BATCH_ROWS):
            return _similar_components(docs, width, percent)
    finally:
        conf.set(key, before)


def _similar_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, counts = shingle_sets(batch.column(1), width)
            node = pa.array(node_ids(hashes, counts), mask=counts == 0)
            drawn = pa.array(sketches(hashes, counts), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), node, pa.array(counts), drawn], names=["doc_id", "node", "n", "sketch"]
            )

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            hashes, counts = shingle_sets(batch.column(1), width)
            nodes = node_ids(hashes, counts)
            row, key = _new_keys(hashes, counts, nodes, seen, percent)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(nodes[row])], names=["key", "node"])

    described = materialize(arrow_map(docs, describe, "doc_id long, node long, n long, sketch binary"), "described")
    shared = arrow_map(docs, keys, "key long, node long").repartition("key").sortWithinPartitions("key", "node")
    stars = materialize(arrow_map(shared, _stars, "a long, b long").distinct(), "stars")
    nodes = described.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    del shared
    release(docs.sparkSession)
    ends = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    members = materialize(ends.join(nodes, "node"), "members")
    drawn = described.join(members, (members["node"] == described["node"]) & members["first"].eqNullSafe(described["doc_id"]), "left_semi")
    drawn = materialize(drawn.select("node", "sketch").dropDuplicates(["node"]), "sketches")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, counts = shingle_sets(batch.column(0), width)
            at, nodes = segments(counts), node_ids(hashes, counts)
            some = np.flatnonzero(counts).tolist()
            body = [hashes[at[i] : at[i + 1]].tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(body, pa.binary())], names=["node", "shingles"])

    def sets_of(rows: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes of ``rows``, from the texts of their first documents."""
        few = members.join(rows.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc_id")).distinct()
        few = materialize(few, "wanted")
        # ids go to the texts if they are few enough, or else texts are exchanged
        ids = F.broadcast(few) if few.count() <= BROADCAST_ROWS else few
        texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")
        sets = materialize(arrow_map(texts, fetch, "node long, shingles binary"), "shingles")
        # rows of one doc_id may hold one set several times
        rows_, nodes_ = sets.agg(F.count("*"), F.countDistinct("node")).first()
        return sets if rows_ == nodes_ else materialize(sets.dropDuplicates(["node"]), "shingles")

    def links_of(regions: DataFrame) -> DataFrame:
        rows = materialize(_candidates(regions, drawn, percent), "candidates")
        found = _links(rows, sets_of(rows), percent)
        release(docs.sparkSession)
        return found

    sizes = members.select("node", "n")
    nearest = _regions(stars.groupBy("b").agg(F.min("a").alias("a"))).join(sizes, "node")
    links = links_of(materialize(nearest.withColumn("label", F.col("node")), "nearest"))
    joined = connected_components(links).withColumnRenamed("root", "label")
    rest = _regions(stars).join(sizes, "node").join(joined, "node", "left")
    more = links_of(materialize(rest.withColumn("label", F.coalesce("label", "node")), "rest"))
    # what was joined before stands for its links
    before = joined.select(F.col("node").alias("a"), F.col("label").alias("b"))
    roots = connected_components(before.unionByName(more))
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(least, "root").select("node", "component_id")
    linked = described.where("node IS NOT NULL").join(placed, "node")
    linked = linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = described.where("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked rows: the one with the smallest doc_id.

    Texts without words all stay, and so do rows with a null doc_id, which cannot be told
    apart. Of equal rows one stays.
    """
    found = similar_components(docs.where("doc_id IS NOT NULL"), width, percent)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def _regions(stars: DataFrame) -> DataFrame:
    """(region, node): a pivot's region holds itself and the nodes that share a part with it."""
    pairs = stars.select(F.col("a").alias("region"), F.col("b").alias("node"))
    own = stars.select(F.col("a").alias("region"), F.col("a").alias("node")).distinct()
    return pairs.unionByName(own)


def _new_keys(hashes, counts, nodes, seen: set[int], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Part keys of the sets that this task has not met before."""
    fresh = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes.tolist()):
        if counts[i] and node not in seen:
            seen.add(node)
            fresh[i] = True
    row, key = part_keys(hashes[np.repeat(fresh, counts)], counts[fresh], percent)
    return np.flatnonzero(fresh)[row], key


def _candidates(regions: DataFrame, drawn: DataFrame, percent: int) -> DataFrame:
    """Regions of the nodes that may link under different labels, as their sketches tell."""
    sizes = materialize(_sized(regions, SKETCH_NODES, SKETCH_SHINGLES), "sizes")
    rows = regions.join(sizes.where("leaf").select("region"), "region")
    large = sizes.where("NOT leaf")
    rest = regions.join(large.select("region"), "region")
    rows = rows.unionByName(_blocks(rest, large, SKETCH_NODES, SKETCH_SHINGLES).select(*rows.columns))
    rows = rows.join(drawn, "node").select("region", "node", "n", "label", "sketch")
    rows = rows.repartition("region").sortWithinPartitions("region", "node")
    return arrow_map(rows, _look_alikes(percent), _NARROW).distinct()


def _links(regions: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that join what links within the regions, cutting large ones first."""
    found: list[DataFrame] = []
    for depth in range(DEPTH + 1):
        sizes = materialize(_sized(regions), "sizes")
        leaves = regions.join(sizes.where("leaf").select("region"), "region")
        found.append(_leaf_edges(leaves, sets, percent))
        large = sizes.where("NOT leaf")
        if large.isEmpty():
            break
        rest = regions.join(large.select("region"), "region")
        if depth == DEPTH:
            found.append(_leaf_edges(_blocks(rest, large), sets, percent))
            break
        regions, blocks, met = _cut(_with_sets(rest, sets).select("region", "node", "n", "label", "shingles"), percent)
        regions = materialize(regions, "regions")
        found += [met, _leaf_edges(blocks, sets, percent)]
        release(regions.sparkSession)
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def _with_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows with their nodes' sets. Up to ``BROADCAST_ROWS`` narrow rows go to the sets, more
    are joined by an exchange of both."""
    few = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return sets.join(F.broadcast(rows) if few else rows, "node")


def _leaf_edges(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    rows = _with_sets(rows, sets).select("region", "node", "label", "shingles")
    rows = rows.repartition("region").sortWithinPartitions("region", "node")
    return materialize(arrow_map(rows, _join_leaves(percent), "a long, b long"), "leaves")
