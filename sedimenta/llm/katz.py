"""Katz backoff language model: counts, discounts, weights and scores.

Tokens are lower-cased words and one end per text; a text starts from a history of its own.

    P(w | h) = d_r r / c(h)        if the pair (h, w) was seen r > 0 times
             = a(h) P(w)           else, with a(h) such that all w and one unknown sum to 1
    P(w)     = d_c c / N           if w was seen c > 0 times
             = what that leaves    else (the unknown)

d_r are Good-Turing discounts up to LARGEST occurrences and 1 - TAIL above, so that every
history leaves some mass. A history never seen backs off with weight 1.

Tokens move once. Each is dealt by its word (a frequent word's by the pair), so a bucket
knows the counts of its words and pairs. What a score needs of other buckets is additive:
log c(h) is added where h is the word, discounts once their counts are known, and
log(a(h) c(h)) by a second exchange of the unseen pairs' histories alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_groups, arrow_map, fold_of, hash_words, mix, segments, slices, text_batches, text_buffers
from sedimenta.scratch import materialize

#: Documents held out of learning: crc32(doc_id as text) mod FOLDS == HELD_OUT.
FOLDS, HELD_OUT = 5, 1
LARGEST = 5
TAIL = 1e-4
#: Tokens (and documents) that a task packs at a time; tokens of a bucket, about.
CHUNK_TOKENS, CHUNK_DOCS = 1_500_000, 60_000
BUCKET_TOKENS = 1_000_000
#: Buckets of words to one of histories, which holds less per token.
BUCKETS_PER_TARGET = 4
#: Pairs of a history that have 1 .. LARGEST occurrences, and the occurrences of the others.
_KINDS = LARGEST + 1

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_SHORT = np.uint64(16)  # histories are told by the upper 48 bits of a word's hash


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of each text, each ending with END, and their numbers."""
    raw, offsets = text_buffers(column)
    words, n = hash_words(raw, offsets)
    out = np.full(len(words) + len(n), END, np.uint64)
    at = segments(n + 1)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = words
    return out, n + 1


def discounts(counts_of_counts) -> np.ndarray:
    """d[0] for r over LARGEST, d[r] for r = 1 .. LARGEST, from n[1] .. n[LARGEST + 1].

    Where Good and Turing's estimate is no proper discount, half an occurrence is taken off.
    """
    n = np.concatenate([[0.0], np.asarray(counts_of_counts, float)])
    d = np.array([1 - TAIL] + [(r - 0.5) / r for r in range(1, LARGEST + 1)])
    if (n[1:] > 0).all():
        common = (LARGEST + 1) * n[LARGEST + 1] / n[1]
        for r in range(1, LARGEST + 1):
            if common != 1:
                turing = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common)
                if 0 < turing < 1:
                    d[r] = turing
    return d


def _of(d: np.ndarray, r: np.ndarray) -> np.ndarray:
    return d[np.where(r <= LARGEST, r, 0)]


class Unigrams:
    """Totals of the training tokens and the discounted shares of their words."""

    def __init__(self, total: int, kinds: int, counts_of_counts: list[int], in_small: list[int]):
        self.total, self.kinds = total, kinds
        self.d = discounts(counts_of_counts)
        small = np.arange(1, LARGEST + 1) * np.array(in_small[:LARGEST], float)
        left = ((1 - self.d[1:]) * small).sum() + TAIL * (total - small.sum())
        self.unknown = left / total if total else 1.0

    def share(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, _of(self.d, c) * c / max(self.total, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.kinds + 1)))


def _is_held_out(ids: pa.Array) -> np.ndarray:
    return np.array([fold_of(i, FOLDS) == HELD_OUT for i in ids.to_pylist()], bool)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        word, count = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "c"])

    for batch in slices(batches):
        token, n = tokens(batch.column(1))
        held.append(token[np.repeat(~_is_held_out(batch.column(0)), n)])
        if sum(map(len, held)) > 2 * CHUNK_TOKENS:
            yield flush()
    if held:
        yield flush()


PIECE = "bucket long, chunk long, trained int, docs int, words binary, pairs binary, before binary, times binary, doc binary"
_PIECE = pa.schema(
    [("bucket", pa.int64()), ("chunk", pa.int64()), ("trained", pa.int32()), ("docs", pa.int32())]
    + [(c, pa.binary()) for c in ("words", "pairs", "before", "times", "doc")]
)


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0].astype(np.uint64)


def _pack(chunk: int, held: list[tuple], buckets: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A chunk's tokens as one row per bucket, and a row of its documents.

    Documents are numbered, those learned from first. A bucket's row has its distinct
    words, the pairs of each, each pair's history and tokens, and these tokens' documents.
    """
    ids = pa.concat_arrays([i for i, _, _, _ in held])
    token, n, out = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
    order = np.argsort(out, kind="stable")
    number = np.empty(len(n), np.int64)
    number[order] = np.arange(len(n))
    trained = int((~out).sum())
    about = [np.ascontiguousarray(x).tobytes() for x in (n[order], out[order].astype(np.uint8))]
    listed = ids.take(pa.array(order))
    known = np.array(listed.is_valid().to_numpy(zero_copy_only=False), np.uint8).tobytes()
    listed = listed.fill_null(0).to_numpy().astype(np.int64).tobytes()
    yield pa.RecordBatch.from_arrays(
        [pa.array([x], t) for x, t in zip([-1 - chunk, chunk, trained, len(n), listed, about[0], about[1], known, b""], _PIECE.types)],
        schema=_PIECE,
    )
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[segments(n)[:-1]] = START
    before >>= _SHORT
    doc = np.repeat(number, n)
    bucket = (token % np.uint64(buckets)).astype(np.int64)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)] == token
        bucket[often] = (mix(token[often] + mix(before[often])) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((before, token, bucket.astype(np.uint16 if buckets < 1 << 16 else np.int64)))
    token, before, doc, bucket = token[order], before[order], doc[order], bucket[order]
    new_bucket = np.ones(len(token), bool)
    new_bucket[1:] = bucket[1:] != bucket[:-1]
    new_word = new_bucket.copy()
    new_word[1:] |= token[1:] != token[:-1]
    new_pair = new_word.copy()
    new_pair[1:] |= before[1:] != before[:-1]
    at = np.append(np.flatnonzero(new_bucket), len(token))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        w, p = np.flatnonzero(new_word[a:b]), np.flatnonzero(new_pair[a:b])
        parts = [
            token[a:b][w].tobytes(),
            np.diff(np.searchsorted(p, np.append(w, b - a))).astype(np.uint32).tobytes(),
            _six(before[a:b][p]),
            np.diff(np.append(p, b - a)).astype(np.uint32).tobytes(),
            doc[a:b].astype(np.uint16).tobytes(),
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip([int(bucket[a]), chunk, trained, len(n), *parts], _PIECE.types)], schema=_PIECE
        )


RESULT = "kind int, target long, chunk long, a binary, b binary, c binary, d binary"
_RESULT = pa.schema(
    [("kind", pa.int32()), ("target", pa.int64()), ("chunk", pa.int64())] + [(c, pa.binary()) for c in "abcd"]
)
_DOCS, _SUMS, _LEFT, _UNSEEN, _COUNTS = range(5)


def _packed(x: np.ndarray) -> bytes:
    return len(x.tobytes()).to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), kind) if size else np.zeros(0, kind)


def _rows(rows: list[list]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_RESULT.types)], schema=_RESULT)


def _learn_and_score(words: Unigrams, frequent: np.ndarray, counts: np.ndarray, targets: int):
    """Of one bucket: sums per document, what histories leave, unseen pairs, counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return _rows(
                [[_DOCS, r["chunk"], r["chunk"], r["words"], r["pairs"], r["before"], r["times"]] for r in table.to_pylist()]
            )
        word, before, pair_word, taught, pieces = [], [], [], [], []
        first = 0
        columns = {c: table.column(c) for c in ("chunk", "trained", "docs", "words", "pairs", "before", "times", "doc")}
        for i in range(table.num_rows):
            # a row's bytes are looked at where they lie
            r = {c: v[i].as_buffer() if v.type == pa.binary() else v[i].as_py() for c, v in columns.items()}
            w, h = np.frombuffer(r["words"], np.uint64), _from_six(r["before"])
            times, doc = np.frombuffer(r["times"], np.uint32).astype(np.int64), np.frombuffer(r["doc"], np.uint16)
            word.append(w)
            before.append(h)
            pair_word.append(first + np.repeat(np.arange(len(w)), np.frombuffer(r["pairs"], np.uint32)))
            taught.append(np.add.reduceat((doc < r["trained"]).astype(np.int64), segments(times)[:-1]))
            pieces.append((r["chunk"], r["docs"], times, doc))
            first += len(w)
        word, h, pair_word, taught = (np.concatenate(x) for x in (word, before, pair_word, taught))
        distinct, word_of = np.unique(word, return_inverse=True)
        pair_word = word_of[pair_word]
        c = np.bincount(pair_word, taught, len(distinct)).astype(np.int64)
        if len(frequent):
            place = np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)
            c = np.where(frequent[place] == distinct, counts[place], c)
        _, one, same = np.unique(mix(distinct[pair_word] + mix(h)), return_index=True, return_inverse=True)
        seen = np.bincount(same, taught, len(one)).astype(np.int64)
        out = [[_COUNTS, 0, 0, np.bincount(np.minimum(seen, LARGEST + 2), minlength=LARGEST + 3).astype(np.int64).tobytes(), b"", b"", b""]]
        share = words.share(c)
        # what each history leaves, and the share of its words, over the pairs learned
        has = seen > 0
        left_h, which = np.unique(h[one][has], return_inverse=True)
        r = seen[has]
        mass = np.bincount(which, share[pair_word[one]][has], len(left_h))
        kinds = np.zeros((_KINDS, len(left_h)), np.uint32)
        for k in range(1, LARGEST + 1):
            kinds[k - 1] = np.bincount(which[r == k], minlength=len(left_h))
        more = r > LARGEST
        over = np.bincount(which[more], r[more], len(left_h))
        for t, at in _targets(left_h, targets):
            out.append([_LEFT, t, 0, left_h[at].tobytes(), mass[at].tobytes(), _packed(kinds[:LARGEST, at]), _packed(over[at])])
        # each document's sums
        of_token_end = np.where(distinct == END, 0.0, np.log10(np.maximum(c, 1)))
        base, log_share = words.base(c), np.log10(share)
        first = 0
        for chunk, docs, times, doc in pieces:
            span = slice(first, first + len(times))
            first += len(times)
            r, w = np.repeat(seen[same[span]], times), np.repeat(pair_word[span], times)
            x = np.where(r > 0, np.log10(np.maximum(r, 1)), log_share[w]) - of_token_end[w]
            sums = np.stack([np.bincount(doc, x, docs), np.bincount(doc, base[w], docs)])
            small = np.zeros((_KINDS + 1, docs), np.uint32)
            small[0] = np.bincount(doc[c[w] > 0], minlength=docs)
            for k in range(1, LARGEST + 1):
                small[k] = np.bincount(doc[r == k], minlength=docs)
            small[_KINDS] = np.bincount(doc[r > LARGEST], minlength=docs)
            out.append([_SUMS, chunk, chunk, _packed(sums), _packed(small), b"", b""])
            new = np.flatnonzero(r == 0)
            if len(new):
                hist, d = np.repeat(h[span], times)[new], doc[new]
                for t, at in _targets(hist, targets):
                    out.append([_UNSEEN, t, chunk, hist[at].tobytes(), d[at].tobytes(), docs.to_bytes(4, "little"), b""])
        return _rows(out)

    return run


def _targets(h: np.ndarray, targets: int) -> Iterator[tuple[int, np.ndarray]]:
    target = (mix(h) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    at = np.append(np.flatnonzero(np.diff(target[order], prepend=-1)), len(h))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield int(target[order[a]]), order[a:b]


def _back_off(d: np.ndarray):
    """log10(a(h) c(h)) of the unseen pairs' histories, summed per document."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        left = [r for r in rows if r["kind"] == _LEFT]
        h = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["a"], np.uint64) for r in left)])
        kinds = [_unpacked(r["c"], np.uint32).reshape(LARGEST, -1) for r in left]
        weight = np.arange(1, LARGEST + 1) * (1 - d[1:])
        mass = [weight @ k + TAIL * _unpacked(r["d"], float) for k, r in zip(kinds, left)]
        distinct, which = np.unique(h, return_inverse=True)
        kept = np.bincount(which, np.concatenate([np.zeros(0), *mass]), len(distinct))
        share = np.bincount(which, np.concatenate([np.zeros(0), *(np.frombuffer(r["b"], float) for r in left)]), len(distinct))
        value = np.log10(kept / np.maximum(1 - share, 1e-12)) if len(distinct) else np.zeros(0)
        out = []
        for r in rows:
            if r["kind"] == _UNSEEN and len(distinct):
                hist, doc = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.uint16)
                place = np.minimum(np.searchsorted(distinct, hist), len(distinct) - 1)
                x = np.where(distinct[place] == hist, value[place], 0.0)
                docs = int.from_bytes(r["c"], "little")
                sums = np.zeros((2, docs))
                sums[0] = np.bincount(doc, x, docs)
                out.append([_SUMS, r["chunk"], r["chunk"], _packed(sums), b"", b"", b""])
        return _rows(out)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _gather(words: Unigrams, d: np.ndarray, log_texts: float):
    def run(table: pa.Table) -> pa.Table:
        sums = small = about = None
        for r in table.to_pylist():
            if r["kind"] == _DOCS:
                about = r
                continue
            x = _unpacked(r["a"], float).reshape(2, -1)
            sums = x if sums is None else sums + x
            if r["b"]:
                k = _unpacked(r["b"], np.uint32).reshape(_KINDS + 1, -1).astype(np.int64)
                small = k if small is None else small + k
        ids = np.frombuffer(about["a"], np.int64)
        known = np.frombuffer(about["d"], np.uint8) == 0
        # small: known tokens, pairs seen 1 .. LARGEST times, pairs seen more often
        score = sums[0] + np.log10(d[1:]) @ small[1:_KINDS] + np.log10(d[0]) * small[_KINDS] - log_texts
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=known),
                "held_out": np.frombuffer(about["c"], np.uint8) > 0,
                "n_tokens": np.frombuffer(about["b"], np.int64),
                "n_known": small[0],
                "train_tokens": np.full(len(ids), words.total, np.int64),
                "base_score": sums[1],
                "score": score,
            }
        )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row.

    Learns from the rows of ``docs`` (doc_id, text) that are not held out and scores all,
    in log10. ``base_score`` is the smoothed unigram score.

    Null text is empty: one token, the end. A null doc_id hashes as empty text; rows with
    one doc_id count each. Without training rows every score is 0. No rows give no rows;
    further columns are ignored. Words are told by 64-bit hashes, histories by 48 bits.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = arrow_map(docs, _count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counted = materialize(counted, "unigrams")
    few = [F.count_if(F.col("c") == r) for r in range(1, LARGEST + 2)]
    total, kinds, *few = (x or 0 for x in counted.agg(F.sum("c"), F.count("*"), *few).first())
    words = Unigrams(total, kinds, few, few)
    buckets = max(4, -(-total * FOLDS // (FOLDS - 1) // BUCKET_TOKENS))
    # at most 4 * buckets words are that frequent
    often = counted.where(F.col("c") > total / (4 * buckets)).collect()
    frequent = np.array([r["word"] for r in often], np.int64).view(np.uint64)
    counts = np.array([r["c"] for r in often], np.int64)[np.argsort(frequent)]
    frequent = np.sort(frequent)
    texts = counted.where(F.col("word") == int(END.view(np.int64))).agg(F.sum("c")).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held, size, rows = TaskContext.get().partitionId() << 24, [], 0, 0
        for batch in slices(batches):
            token, n = tokens(batch.column(1))
            if held and (size + len(token) > CHUNK_TOKENS or rows + len(n) > CHUNK_DOCS):
                yield from _pack(chunk, held, buckets, frequent)
                chunk, held, size, rows = chunk + 1, [], 0, 0
            held.append((batch.column(0), token, n, _is_held_out(batch.column(0))))
            size, rows = size + len(token), rows + len(n)
        if held:
            yield from _pack(chunk, held, buckets, frequent)

    pieces = arrow_map(docs, pack, PIECE)
    with text_batches(spark, 64):
        learned = materialize(arrow_groups(pieces, ["bucket"], _learn_and_score(words, frequent, counts, -(-buckets // BUCKETS_PER_TARGET)), RESULT), "pairs")
    of_counts = [np.frombuffer(r["a"], np.int64) for r in learned.where(F.col("kind") == _COUNTS).select("a").collect()]
    d = discounts(np.sum(of_counts, axis=0)[1 : LARGEST + 2] if of_counts else np.zeros(LARGEST + 1))
    exchanged = learned.where(F.col("kind").isin(_LEFT, _UNSEEN))
    corrections = arrow_groups(exchanged, ["target"], _back_off(d), RESULT)
    sums = learned.where(F.col("kind").isin(_DOCS, _SUMS)).unionByName(corrections)
    return arrow_groups(sums, ["chunk"], _gather(words, d, float(np.log10(max(texts, 1)))), SCORES)
