"""Token sequences as length-delimited binary records with a separate offset index.

A record is framed as

    uint64 length | uint32 masked crc32c(length) | payload | uint32 masked crc32c(payload)

little-endian, where masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2**32 (fixed values
of the format). The payload is the sequence's ids, two bytes each if the vocabulary has at
most 65,536 ids, else four.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_map, as_uri, partitions, segments, slices, text_batches
from sedimenta.llm.tokens import ENCODE_BYTES, encoder, vocabulary_path
from sedimenta.scratch import scratch_path

#: Appended to each document by the query.
END_ID = 2
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
#: Bytes that the checksum reduces side by side.
SEGMENT = 256
#: Bytes read from a data file at once.
READ_BYTES = 2 << 20


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32C tables: table[k][b] is byte b's remainder k bytes on; the second has the
    remainder of each of a value's four bytes a whole segment on."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(0x82F63B78), first >> 1).astype(np.uint32)
    rows = [first]
    for _ in range(7):
        rows.append((rows[-1] >> 8) ^ first[rows[-1] & 0xFF])
    ahead = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(SEGMENT):
        ahead = (ahead >> 8) ^ first[ahead & 0xFF]
    return np.array(rows), ahead


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload.

    The checksum is linear, and leading zeros do not change it once its initial ones are
    folded into the first four bytes. So payloads are filled up in front to whole segments,
    all segments are reduced side by side, and each payload's are then joined in order.
    """
    payloads = [p if len(p) >= 4 else None for p in payloads], [p for p in payloads if len(p) < 4]
    whole = [p for p in payloads[0] if p is not None]
    rows, ahead = _tables()
    out = np.empty(len(payloads[0]), np.uint32)
    is_short = np.array([p is None for p in payloads[0]], bool)
    for i, p in zip(np.flatnonzero(is_short).tolist(), payloads[1]):
        crc = 0xFFFFFFFF
        for byte in p:
            crc = (crc >> 8) ^ int(rows[0][(crc ^ byte) & 0xFF])
        out[i] = crc ^ 0xFFFFFFFF
    if whole:
        lengths = np.array([len(p) for p in whole], np.int64)
        counts = -(-lengths // SEGMENT)
        at = segments(counts)
        raw = np.zeros(at[-1] * SEGMENT, np.uint8)
        start = at[1:] * SEGMENT - lengths
        ends = np.cumsum(lengths)
        raw[np.arange(ends[-1]) + np.repeat(start - (ends - lengths), lengths)] = np.frombuffer(b"".join(whole), np.uint8)
        raw[start[:, None] + np.arange(4)] ^= 0xFF
        words = raw.reshape(-1, SEGMENT)
        crc = np.zeros(len(words), np.uint32)
        for k in range(0, SEGMENT, 8):
            low = words[:, k : k + 4].copy().view("<u4")[:, 0] ^ crc
            crc = rows[7][low & 0xFF] ^ rows[6][(low >> 8) & 0xFF] ^ rows[5][(low >> 16) & 0xFF] ^ rows[4][low >> 24]
            for j in range(4):
                crc = crc ^ rows[3 - j][words[:, k + 4 + j]]
        order = np.argsort(-counts, kind="stable")
        total = np.zeros(len(whole), np.uint32)
        live = np.searchsorted(-counts[order], -np.arange(1, counts.max() + 1), side="right")
        for step, n in enumerate(live.tolist()):
            own = order[:n]
            c = total[own]
            moved = ahead[0][c & 0xFF] ^ ahead[1][(c >> 8) & 0xFF] ^ ahead[2][(c >> 16) & 0xFF] ^ ahead[3][c >> 24]
            total[own] = moved ^ crc[at[own] + step]
        out[~is_short] = ~total
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint64)
    return (((crc >> np.uint64(15)) | (crc << np.uint64(17))) + np.uint64(_MASK)) & np.uint64(0xFFFFFFFF)


def frame(payloads: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    of_head, of_body = masked(crc32c(heads)), masked(crc32c(payloads))
    return [
        h + struct.pack("<I", a) + p + struct.pack("<I", b)
        for h, a, p, b in zip(heads, of_head.tolist(), payloads, of_body.tolist())
    ]


def unframe(data: bytes, offsets: list[int], lengths: list[int]) -> list[bytes]:
    """Payloads of the records at these places; a wrong length or checksum is an error."""
    heads = [data[o : o + 8] for o in offsets]
    payloads = [data[o + 12 : o + n - 4] for o, n in zip(offsets, lengths)]
    of_head = np.array([struct.unpack_from("<I", data, o + 8)[0] for o in offsets], np.uint64)
    of_body = np.array([struct.unpack_from("<I", data, o + n - 4)[0] for o, n in zip(offsets, lengths)], np.uint64)
    sizes = [struct.unpack("<Q", h)[0] for h in heads]
    if sizes != [len(p) for p in payloads] or (masked(crc32c(heads)) != of_head).any():
        raise ValueError("damaged record length")
    if (masked(crc32c(payloads)) != of_body).any():
        raise ValueError("damaged record payload")
    return payloads


INDEX = "file string, part int, record long, doc_id long, offset long, length long, n_tokens long, local_start long"
_INDEX = pa.schema(
    [("file", pa.string()), ("part", pa.int32())]
    + [(c, pa.int64()) for c in ("record", "doc_id", "offset", "length", "n_tokens", "local_start")]
)


def write_records(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """Encode texts and write them to record files in ascending doc_id order; the index.

    ``docs`` has doc_id and text. Rows are dealt to ranges of doc_id and sorted within, so
    file n+1 continues file n. Each task streams one file of the folder and gives an index
    row per record: file, part, record (its number there), doc_id, offset and length (of
    the framed record), n_tokens and local_start (ids before it in the file). A file's
    name is new for every attempt and the index, a Parquet table next to the files, names
    only those of the attempts that counted, so lost executors leave no doubles.

    Null text is empty and still gets a record (of the end id). Null doc_id comes first.
    Rows with one doc_id are written each, in order of their text. No rows, no files.
    Further columns are ignored.
    """
    path = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    wide = encoder(path).tokenizer.get_vocab_size() > 1 << 16 or (end_id or 0) >= 1 << 16
    kind = np.uint32 if wide else np.uint16

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(path).encode_column, TaskContext.get().partitionId()
        out, name, offset, record, before = None, "", 0, 0, 0
        try:
            for batch in slices(batches, ENCODE_BYTES):
                if out is None:
                    store, root = fs.FileSystem.from_uri(folder)
                    store.create_dir(root, recursive=True)
                    name = f"part-{part:05d}-{uuid.uuid4().hex}.rec"
                    out = store.open_output_stream(f"{root}/{name}")
                ids, counts = encode(batch.column(1))
                at = segments(counts)
                tail = [] if end_id is None else [end_id]
                rows = [np.append(ids[a:b], tail).astype(kind) for a, b in zip(at[:-1], at[1:])]
                framed = frame([r.tobytes() for r in rows])
                out.write(b"".join(framed))
                n, size = np.array([len(r) for r in rows]), np.array([len(f) for f in framed])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(rows)),
                        pa.array(np.full(len(rows), part, np.int32)),
                        pa.array(np.arange(record, record + len(rows))),
                        batch.column(0),
                        pa.array(offset + np.cumsum(size) - size),
                        pa.array(size),
                        pa.array(n),
                        pa.array(before + np.cumsum(n) - n),
                    ],
                    schema=_INDEX,
                )
                pa.default_memory_pool().release_unused()
                record, offset, before = record + len(rows), offset + int(size.sum()), before + int(n.sum())
        finally:
            if out is not None:
                out.close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    with text_batches(spark):
        arrow_map(ordered, write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(
    index: DataFrame, folder: str, finish: Callable | None = None, schema: str = INDEX + ", ids binary"
) -> DataFrame:
    """Rows of the index with the ids of their records (``ids``, binary, as stored).

    Any subset and order of index rows will do. Neighbours in a file are read together.
    ``finish`` turns each batch into one of ``schema`` where it was read.
    """
    whole = pa.schema(list(_INDEX) + [("ids", pa.binary())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            at = 0
            while at < len(files):
                to = at + 1
                while (
                    to < len(files)
                    and files[to] == files[at]
                    and offsets[to] == offsets[to - 1] + lengths[to - 1]
                    and offsets[to] + lengths[to] - offsets[at] <= READ_BYTES
                ):
                    to += 1
                with store.open_input_file(f"{root}/{files[at]}") as f:
                    data = f.read_at(offsets[to - 1] + lengths[to - 1] - offsets[at], offsets[at])
                got = unframe(data, [o - offsets[at] for o in offsets[at:to]], lengths[at:to])
                part = batch.slice(at, to - at)
                out = pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.binary())], schema=whole)
                yield finish(out) if finish else out
                at = to

    return arrow_map(index, load, schema)


def record_digest(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents, read the files back, and describe what was read.

    Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of
    the ids as little-endian unsigned 32-bit integers).
    """
    folder = as_uri(scratch_path(docs.sparkSession, "records"))
    index = write_records(docs, folder, vocabulary, end_id)
    path = vocabulary or vocabulary_path()
    kind = np.uint32 if encoder(path).tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16 else np.uint16

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(x, kind).astype("<u4") for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "part": batch.column("part"),
                "local_start": batch.column("local_start"),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
            }
        )

    read = read_records(
        index, folder, digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long"
    )
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("base"))
    return read.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
