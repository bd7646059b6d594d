"""Token ids of whole texts by the tokenizers library, with a memory of seen words."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from sedimenta.llm.shared import segments, span_hashes, text_buffers

#: The vocabulary file; a parameter of every operator that needs ids.
VOCABULARY = "byte_bpe_50k.json"
#: Distinct pieces a worker remembers before it starts afresh.
REMEMBERED = 1_000_000
#: Bytes of text encoded at a time.
ENCODE_BYTES = 3 << 19
#: Pieces encoded by one call of the library.
AT_ONCE = 10_000
#: What the vocabulary's byte-level pre-tokenizer splits by (a fixed value of the format).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters above ASCII that are Latin letters; texts with others are cut by PIECES.
_LATIN = "".join(chr(c) for c in range(0x80, 0x250) if chr(c).isalpha())
_NOT_LATIN = re.compile(f"[^\\x00-\\x7f{_LATIN}]")
_CONTROL = re.compile("[\\x1c-\\x1f\\x85]")

_WORD, _MARK, _BLANK, _BREAK = 0, 1, 2, 3
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = _WORD
_KIND[0x20], _KIND[0x0A] = _BLANK, _BREAK
_RARE = np.zeros(256, bool)
_RARE[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x27]] = True


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False).ids`` does.

    A byte-level vocabulary merges only within the pieces its pre-tokenizer cuts, so a
    text's ids are those of its pieces in turn, and only pieces not seen before go to the
    library. Plain Latin texts are cut by array operations: at single blanks and breaks,
    and where letters or digits meet other characters. Texts with apostrophes, wider white
    space or other scripts are cut by the pre-tokenizer's own pattern. Those with control
    characters or the string of a special token go to the library whole. Pieces are looked
    up by a 64-bit hash.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        # in this vocabulary a character stands for a byte, so this is a token's length
        self.width = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self._forget()

    def _forget(self) -> None:
        """Known pieces: their hashes, sorted, where each is kept, and the ids of all."""
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.at, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint16 if len(self.width) <= 1 << 16 else np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def pieces(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one after the other, and how many each has.

        Consecutive parts of a blank and more are encoded as one text and then cut, so
        callers put those first.
        """
        n = 0
        while n < len(parts) and parts[n][0] == " " and len(parts[n]) > 1 and not parts[n].isspace():
            n += 1
        joined, alone = parts[:n], parts[n:]
        ids = np.concatenate([self.whole("".join(joined[i : i + AT_ONCE])) for i in range(0, max(n, 1), AT_ONCE)])
        ends = np.cumsum([len(p.encode()) for p in joined])
        cut = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
        got = [x.ids for x in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
        sizes = np.concatenate([np.diff(cut, prepend=0), [len(x) for x in got]]).astype(np.int64)
        return np.concatenate([ids, *(np.array(x, np.uint32) for x in got)]), sizes

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        behind = np.array([p[0] != " " or p.isspace() for p in parts])
        order = np.argsort(behind, kind="stable")
        ids, sizes = self.pieces([parts[i] for i in order.tolist()])
        place = np.empty(len(parts), np.int32)
        place[order] = np.arange(len(self.at) - 1, len(self.at) - 1 + len(parts))
        self.at = np.concatenate([self.at, np.cumsum(sizes) + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
        self.known, self.place = np.concatenate([self.known, keys]), np.concatenate([self.place, place])
        order = np.argsort(self.known, kind="stable")
        self.known, self.place = self.known[order], self.place[order]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has. Nulls are empty."""
        raw, offsets = text_buffers(column)
        counts = np.zeros(len(offsets) - 1, np.int64)
        if not len(raw):
            return np.zeros(0, np.uint32), counts
        kind = _KIND[raw]
        first = np.zeros(len(raw) + 1, bool)
        first[offsets] = True
        first = first[:-1]
        space = kind >= _BLANK
        odd = _RARE[raw]
        odd[1:] |= space[1:] & space[:-1] & ~first[1:]
        special = any(s.encode() in raw.tobytes() for s in self.special)
        total = segments(odd)
        rare = total[offsets[1:]] > total[offsets[:-1]]
        total = segments(raw >= 0x80)
        wide = total[offsets[1:]] > total[offsets[:-1]]
        other: dict[int, np.ndarray] = {}
        for i in np.flatnonzero((rare | wide | special) & (offsets[1:] > offsets[:-1])):
            text = column[int(i)].as_py() or ""
            if special and any(s in text for s in self.special) or _CONTROL.search(text):
                other[i] = self.whole(text)
            elif rare[i] or _NOT_LATIN.search(text):
                parts = PIECES.findall(text)
                distinct = sorted(dict.fromkeys(parts), key=lambda p: (p[0] != " " or p.isspace()))
                ids, sizes = self.pieces(distinct)
                table = dict(zip(distinct, np.split(ids, np.cumsum(sizes)[:-1])))
                other[i] = np.concatenate([table[p] for p in parts])
        start = (kind >= _BLANK) | first
        start[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK)
        s = np.flatnonzero(start)
        e = np.append(s[1:], len(raw))
        if other:
            left_out = np.zeros(len(counts), bool)
            left_out[list(other)] = True
            keep = ~left_out[np.searchsorted(offsets, s, side="right") - 1]
            s, e = s[keep], e[keep]
        ids, sizes = self._look_up(raw, s, e)
        at = segments(sizes)
        bounds = np.searchsorted(s, offsets)
        counts = at[bounds[1:]] - at[bounds[:-1]]
        if other:
            pieces, before = [], 0
            for i in sorted(other):
                here = at[bounds[i]]
                pieces += [ids[before:here], other[i]]
                before, counts[i] = here, len(other[i])
            ids = np.concatenate([*pieces, ids[before:]])
        return ids, counts

    def _look_up(self, raw, s, e) -> tuple[np.ndarray, np.ndarray]:
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.known) > REMEMBERED:
            self._forget()
        keys, first, inverse = np.unique(span_hashes(raw, s, e), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, keys)
        there = at < len(self.known)
        there[there] = self.known[at[there]] == keys[there]
        new = np.flatnonzero(~there)
        if len(new):
            self._learn(keys[new], [raw[a:b].tobytes().decode() for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist())])
        which = self.place[np.searchsorted(self.known, keys)][inverse]
        begin, sizes = self.at[which], self.at[which + 1] - self.at[which]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(begin - (ends - sizes), sizes)
        return self.ids[places].astype(np.uint32), sizes


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary; a worker has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)
