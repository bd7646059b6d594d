"""Packing token sequences into rows of fixed length, certified by lower bounds."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_groups, arrow_map, segments, slices
from sedimenta.llm.tokens import ENCODE_BYTES, encoder, vocabulary_path
from sedimenta.scratch import materialize

CAPACITY = 2048
SEPARATOR_ID = 0
#: Items that one group packs, about. A group's bins and items are held in memory.
GROUP_ITEMS = 50_000
#: Rounds of exchange at most; each joins the groups with gaps in fewer, larger pools.
ROUNDS = 6

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, tie long"
_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32())]
    + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "tie")]
)


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, separator: int = SEPARATOR_ID
) -> DataFrame:
    """A row per piece of each document: doc_id, piece, start, length, ids_crc32, tie.

    A document's ids end with ``separator``. Longer ones are cut into pieces of
    ``capacity`` ids, of which only the first may be shorter. Null text is empty: one
    piece, the separator. ``tie`` tells rows of equal doc_id with unlike texts apart.
    """
    path = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_column
        for batch in slices(batches, ENCODE_BYTES):
            ids, counts = encode(batch.column(1))
            at = segments(counts)
            which, piece, start, length, crc, tie = [], [], [], [], [], []
            for i in range(batch.num_rows):
                own = np.append(ids[at[i] : at[i + 1]], separator).astype("<u4")
                mark = zlib.crc32(own.tobytes())
                bounds = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    which.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(own[a:b].tobytes()))
                    tie.append(mark)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(which, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc, tie)),
                ],
                schema=_PIECES,
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, PIECES)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing of these sizes needs at least, by dual-feasible functions.

    A function is dual-feasible if it gives the items of any one bin at most 1 together;
    its sum over all items then bounds the bins. Used are the identity (total size), and
    for every e up to half a bin the step function that takes items over capacity - e as
    whole, those under e as nothing, and the others as they are; its sum splits in the
    whole ones and the rest, and each item over half a bin needs one of its own.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)[: capacity + 1]
    mass = count * np.arange(capacity + 1)
    best = -(-int(mass.sum()) // capacity)
    over = segments(count)
    weight = segments(mass)
    e = np.arange(0, capacity // 2 + 1)
    whole = over[-1] - over[capacity - e + 1]
    half = capacity // 2
    large = over[capacity - e + 1] - over[np.maximum(half + 1, e)]
    # items of e .. capacity - e: those over half stay apart, the rest fill what they leave
    total = weight[capacity - e + 1] - weight[e]
    mixed = np.maximum(large, -(-total // capacity))
    return max(best, int((whole + mixed).max()))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: largest first, each into the fullest bin that takes it."""
    bins = np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # distinct rooms left, ascending
    opened = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            which = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(at)
        else:
            which, room = opened, capacity
            opened += 1
        bins[i] = which
        left = room - size
        if left:
            if not open_bins[left]:
                bisect.insort(rooms, left)
            open_bins[left].append(which)
    return bins


def _pack_group(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, bool]:
    """Bins of a group's items, and whether a lower bound certifies their number."""
    bins = best_fit_decreasing(sizes, capacity)
    used = int(bins.max()) + 1 if len(bins) else 0
    return bins, used == lower_bound(sizes, capacity)


PACKED = PIECES + ", grp long, bin long, gap boolean"
_PACKED = pa.schema([*_PIECES, ("grp", pa.int64()), ("bin", pa.int64()), ("gap", pa.bool_())])


def _pack(items: DataFrame, capacity: int) -> DataFrame:
    """Pack each group (``grp``) by itself. ``gap`` marks the bins a group may exchange:
    in groups whose number is not certified, those with room for what other groups give."""

    def pack(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [(c, "ascending") for c in ("doc_id", "piece", "tie", "start")])
        table = table.take(order)
        sizes = table.column("length").to_numpy()
        bins, certified = _pack_group(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        gap = np.zeros(len(fill), bool) if certified else fill < capacity
        return pa.Table.from_arrays(
            [*(table.column(c) for c in _PIECES.names), table.column("grp"), pa.array(bins), pa.array(gap[bins])],
            schema=_PACKED,
        )

    return arrow_groups(items, ["grp"], pack, PACKED)


def pack_sequences(
    pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, rounds: int = ROUNDS
) -> DataFrame:
    """Pack pieces (``token_pieces``) into as few sequences as the bounds let one prove.

    Adds sequence_id and offset (gapless from 0). Full pieces are sequences of their own.
    The others are dealt by hash to groups of about ``group_items``; each packs by
    best-fit decreasing and compares its bins with ``lower_bound``. Certified groups are
    done. The bins that are not full of the others are taken apart and exchanged: their
    pieces are dealt anew to a quarter as many groups and packed again, until all groups
    are certified, one group is left, or ``rounds`` are over. A group never holds more
    than about ``group_items`` pieces: where more are left over, more groups remain.

    Pieces are told apart by doc_id, piece and tie, and equal rows by nothing: they may
    swap places. No rows give no rows.
    """
    pieces = materialize(pieces, "pieces")
    whole = pieces.where(F.col("length") >= capacity)
    rest = pieces.where(F.col("length") < capacity)
    done: list[DataFrame] = [
        whole.select(*_PIECES.names, F.lit(-1).cast("long").alias("grp"), F.monotonically_increasing_id().alias("bin"))
    ]
    n = rest.count()
    groups = max(1, -(-n // group_items))
    for turn in range(rounds):
        if not n:
            break
        key = F.pmod(F.xxhash64("doc_id", "piece", "tie", F.lit(turn)), F.lit(groups))
        packed = materialize(_pack(rest.withColumn("grp", key + turn * (1 << 40)), capacity), "packed")
        last = groups == 1 or turn == rounds - 1
        done.append(packed.select(*_PIECES.names, "grp", "bin") if last else
                    packed.where("not gap").select(*_PIECES.names, "grp", "bin"))
        if last:
            break
        rest = packed.where("gap").select(*_PIECES.names)
        n = rest.count()
        groups = max(1, -(-groups // 4), -(-n // group_items))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return _placed(out, capacity)


def _placed(packed: DataFrame, capacity: int) -> DataFrame:
    """Sequence numbers and offsets; a sequence is small, so it is placed in one window."""
    order = Window.partitionBy("grp", "bin").orderBy("doc_id", "piece", "tie", "start")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.xxhash64("grp", "bin").alias("sequence_id"),
        F.coalesce(before, F.lit(0)).alias("offset"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Token pieces of all documents with the sequence and offset each is packed at."""
    return pack_sequences(token_pieces(docs, capacity, vocabulary), capacity)
