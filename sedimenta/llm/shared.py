"""Helpers of the corpus operators: tables, hold-out folds and vectorised word hashes."""

from __future__ import annotations

import gc
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.scratch import scratch_path

#: One word: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes hashed at a time; what a block needs in memory is about 60 times that.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def fold_of(doc_id, parts: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_uri(path: str) -> str:
    """A path that ``pyarrow.fs.FileSystem.from_uri`` takes."""
    return path if ":" in path.split("/")[0] else f"file://{path}"


def ship(spark: SparkSession) -> None:
    """Let the executors' Python import this package, wherever the driver has it from."""
    context = spark.sparkContext
    if getattr(context, "sedimenta_shipped", False):
        return
    root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"{root.name}/{source.relative_to(root)}")
    path = as_uri(scratch_path(spark, "package") + ".zip")
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    with store.open_output_stream(place) as f:
        f.write(packed.getvalue())
    context.addPyFile(path)
    context.sedimenta_shipped = True


@contextmanager
def text_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """For jobs run within: fewer rows to an Arrow batch than Spark's 10,000, as texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of plans that nothing refers to any more.

    It does so when the driver collects its garbage, which a driver with little to do
    puts off while a chain of large jobs fills the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on every executor."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def arrow_groups(df: DataFrame, keys: list, fn: Callable, schema: str) -> DataFrame:
    """``applyInArrow`` for each group, likewise."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(fn, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (murmur's finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers[key][:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the row offsets into them, without a copy per row. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_blocks(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> Iterator[tuple]:
    """(starts, ends, span hash function) of the words of block after block.

    Words are runs of bytes that ``space`` does not mark; they never span rows. Blocks are
    cut at such bytes or at row starts, so a long text costs no more memory at once. The
    function hashes spans of the block, A-Z lower-cased.
    """
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    at, end = 0, len(raw)
    while at < end:
        stop = min(at + BLOCK_BYTES, end)
        if stop < end:
            cuts = np.flatnonzero(space[raw[at + 1 : stop]] | first[at + 1 : stop])
            if len(cuts):
                stop = at + 1 + int(cuts[-1])
            else:  # a word longer than a block
                rest = np.flatnonzero(space[raw[stop:]] | first[stop:end])
                stop = stop + int(rest[0]) if len(rest) else end
        block = raw[at:stop]
        inside = ~space[block]
        head = inside.copy()
        head[1:] &= ~inside[:-1] | first[at + 1 : stop]
        tail = inside.copy()
        tail[:-1] &= ~inside[1:] | first[at + 1 : stop]
        s, e = np.flatnonzero(head), np.flatnonzero(tail) + 1
        if len(s):
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum((_LOWER[block].astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(block)), out=sums[1:])
            back = _power(_INVERSE, len(block))

            def spans(a, b, sums=sums, back=back):
                return mix(((sums[b] - sums[a]) * back[a]) ^ ((b - a).astype(np.uint64) << np.uint64(48)))

            yield s, e, spans, at
        at = stop


def hash_words(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words and how many each row has."""
    hashes, starts = [], []
    for s, e, spans, at in word_blocks(raw, offsets, space):
        hashes.append(spans(s, e))
        starts.append(s + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    bounds = np.searchsorted(np.concatenate(starts), offsets)
    return np.concatenate(hashes), np.diff(bounds)


def span_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ascending, disjoint byte spans [s, e), case kept."""
    out = np.empty(len(s), np.uint64)
    at = 0
    while at < len(s):
        low = s[at]
        to = max(at + 1, int(np.searchsorted(e, low + BLOCK_BYTES, side="right")))
        n = int(e[to - 1] - low)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw[low : low + n].astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
        a, b = s[at:to] - low, e[at:to] - low
        out[at:to] = mix(((sums[b] - sums[a]) * _power(_INVERSE, n)[a]) ^ ((b - a).astype(np.uint64) << np.uint64(48)))
        at = to
    return out


def slices(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut to rows of about ``limit`` bytes together, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * limit / max(batch.nbytes, 1)))
        for i in range(0, rows, step):
            yield batch.slice(i, step)


def segments(counts: np.ndarray) -> np.ndarray:
    """Starts of consecutive groups of these sizes, with the end."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
