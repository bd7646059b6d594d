"""Personal data in texts, disguised spellings included, at exact source offsets."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_map, segments, slices, text_buffers, word_blocks

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the look-behind only saves time: a match never starts within a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like a Latin one, after Unicode's own
# compatibility forms (full width, mathematical, circled ...) are resolved.
_LOOKALIKES = dict(
    zip("АВЕКМНОРСТУХаеорсухіјѕԁԛԝһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧαοριкмтвнɑɡıǀ", "ABEKMHOPCTYXaeopcyxijsdqwhlABEZHIKMNOPTYXaopikmtbhagil")
)
_DASHES = "‐‑‒–—―−﹘﹣－"
_DOTS = "。．｡․·•"
# Digits as words in the languages of the corpus.
_DIGIT_WORDS = {
    word: str(i % 10)
    for words in (
        "zero one two three four five six seven eight nine",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for i, word in enumerate(words.split())
}
_DOT_WORDS = ("dot", "punkt", "point", "punto", "period")
_AT_WORDS = ("at", "arroba", "ät", "chez")

_DIGIT = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_DOT = "|".join(_DOT_WORDS)
_AT = "|".join(_AT_WORDS)
_I = re.IGNORECASE
_SPELLED = re.compile(
    rf"(?<!\w)(?:plus\s+)?(?:{_DIGIT}|[0-9]+)(?:(?:[\s,;-]{{1,3}}|\s*\.\s*|\s+(?:{_DOT}|dash|hyphen|minus)\s+)(?:{_DIGIT}|[0-9]+)(?!\w)){{2,}}",
    _I,
)
_SPELLED_PART = re.compile(rf"(?<!\w)(plus)\s+|(?<!\w)({_DIGIT})(?!\w)|([0-9]+)|\s+(?:{_DOT})\s+|\s*(\.)\s*|\s+(?:dash|hyphen|minus)\s+|[\s,;-]+", _I)
_BRACKET_AT = re.compile(rf"\s*[\[({{<]\s*(?:{_AT}|@)\s*[\])}}>]\s*", _I)
_BRACKET_DOT = re.compile(rf"\s*[\[({{<]\s*(?:{_DOT}|\.)\s*[\])}}>]\s*", _I)
_LABEL = r"[A-Za-z0-9][A-Za-z0-9-]*"
_NAME = r"[A-Za-z0-9][A-Za-z0-9%+-]*"
# Endings that end a domain spelled in words; none is a common English word.
_ENDING = "com|org|net|edu|gov|mil|info|biz|io|co|uk|de|fr|es|eu|ca|au|nz|jp|cn|ru|br|mx|nl|pl|se|ch|example|test"
_WORD_AT = r"\s+(?:at|arroba|ät)\s+"
_SPACED = (
    re.compile(
        rf"(?<![\w.]){_NAME}(?:(?:\.|_|\s+(?:{_DOT})\s+){_NAME})*{_WORD_AT}"
        rf"{_LABEL}(?:(?:\.|\s+(?:{_DOT})\s+){_LABEL})*\s+(?:{_DOT})\s+(?:{_ENDING})(?!\w)",
        _I,
    ),
    re.compile(
        rf"(?<![\w.]){_NAME}(?:(?:\.|_|\s+(?:{_DOT})\s+){_NAME})*\s{{0,2}}@\s{{0,2}}"
        rf"{_LABEL}(?:(?:\s?\.\s?|\s+(?:{_DOT})\s+){_LABEL})*(?:\s?\.\s?|\s+(?:{_DOT})\s+)(?:{_ENDING})(?!\w)",
        _I,
    ),
)
_SPACED_PART = re.compile(rf"\s+(?:{_DOT})\s+|{_WORD_AT}|\s*@\s*|\s*\.\s*", _I)
_JOINED = re.compile(rf"(?<![A-Za-z0-9])[A-Za-z0-9.+-]+_(?:{_AT})_{_LABEL}(?:(?:_(?:{_DOT})_|\.){_LABEL})+(?!\w)", _I)
_JOINED_PART = re.compile(rf"_(?:{_DOT})_|_(?:{_AT})_", _I)
_MIXED = re.compile(r"(?<![A-Za-z])[0-9OolI]{2,}(?![A-Za-z])")
# as bytes: what the above need, where words alone don't tell
_BARE_DOT = re.compile(rb"[\[({<][\x09-\x0D\x1C-\x20]*\.[\x09-\x0D\x1C-\x20]*[\])}>]")
_JOINED_AT = re.compile(f"_(?:{_AT}|Ät)(?=_)".encode(), _I)


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def _luhn(digits: list[int]) -> bool:
    doubled = sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + doubled) % 10 == 0


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain identifiers: leftmost, non-overlapping per kind."""
    found = []
    at, behind = text.find("@"), 0
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            behind = domain.end()
        at = text.find("@", max(at + 1, behind))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


class Tape:
    """A text under rewriting: every character knows the source span it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans (ascending, disjoint); what replaces a span stands for all of it."""
        if not edits:
            return
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            texts += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        self.text = "".join([*texts, self.text[at:]])
        self.start = np.concatenate([*starts, self.start[at:]])
        self.end = np.concatenate([*ends, self.end[at:]])


def _plain_character(c: str) -> str:
    if unicodedata.category(c) == "Cf" or "︀" <= c <= "️":
        return ""
    if c in _DASHES:
        return "-"
    if c in _DOTS:
        return "."
    form = unicodedata.normalize("NFKC", c)
    form = _LOOKALIKES.get(form, form)
    if len(form) == 1 and form.isdecimal():
        return str(unicodedata.decimal(form))
    return form if len(form) == 1 and (form.isascii() or form == " ") else c


def _characters(tape: Tape) -> None:
    if tape.text.isascii():
        return
    table = {c: new for c in set(tape.text) if not c.isascii() and (new := _plain_character(c)) != c}
    if table:
        tape.rewrite([(i, i + 1, table[c]) for i, c in enumerate(tape.text) if c in table])


def _spelled_digits(tape: Tape) -> None:
    edits = []
    for run in _SPELLED.finditer(tape.text):
        parts = list(_SPELLED_PART.finditer(tape.text, run.start(), run.end()))
        dots = sum(p[0].strip().lower() in _DOT_WORDS for p in parts)
        if sum(p[2] is not None for p in parts) < 3 and dots < 3:
            continue
        for p in parts:
            if p[1]:
                new = "+"
            elif p[2]:
                new = _DIGIT_WORDS[p[2].lower().replace("\u0307", "")]  # "İ" matches "i"
            elif p[3]:
                continue
            else:
                word = p[0].strip().lower()
                new = "." if word in _DOT_WORDS or word == "." else "-" if word in ("dash", "hyphen", "minus") else ""
            edits.append((p.start(), p.end(), new))
    tape.rewrite(edits)


def _mixed_digits(tape: Tape) -> None:
    edits = []
    for m in _MIXED.finditer(tape.text):
        letters = sum(not c.isdecimal() for c in m[0])
        if 0 < letters <= len(m[0]) - letters:
            edits += [(i, i + 1, "0" if tape.text[i] in "Oo" else "1") for i in range(*m.span()) if tape.text[i] in "OolI"]
    tape.rewrite(edits)


def _disguised_signs(tape: Tape) -> None:
    for pattern, new in ((_BRACKET_AT, "@"), (_BRACKET_DOT, ".")):
        edits = []
        for m in pattern.finditer(tape.text):
            before, after = tape.text[m.start() - 1 : m.start()], tape.text[m.end() : m.end() + 1]
            if before.isalnum() and after.isalnum():
                edits.append((m.start(), m.end(), new))
        tape.rewrite(edits)
    for pattern, inner in (*((p, _SPACED_PART) for p in _SPACED), (_JOINED, _JOINED_PART)):
        edits = []
        for m in pattern.finditer(tape.text):
            for p in inner.finditer(tape.text, m.start(), m.end()):
                edits.append((p.start(), p.end(), "." if p[0].strip("_ \t\r\n").lower() in (*_DOT_WORDS, ".") else "@"))
        tape.rewrite(edits)


def disguised(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Identifiers that appear once disguises are undone, in source offsets.

    Those that lie within a plain one are left out. Transducers in turn resolve lookalike
    characters, spelled digits, letters among digits, and disguised at and dot signs.
    """
    tape = Tape(text)
    for step in (_characters, _spelled_digits, _mixed_digits, _disguised_signs):
        step(tape)
    if tape.text == text:
        return []
    spans = []
    for a, kind, b in identifiers(tape.text):
        start, end = int(tape.start[a]), int(tape.end[b - 1])
        if text[start:end] != tape.text[a:b] and not any(k == kind and s <= start and end <= e for s, k, e in plain):
            spans.append((start, kind, end))
    return spans


def find(text: str, look_behind_disguises: bool = True) -> tuple[list, list]:
    """Plain spans and all spans of a text, each (start, kind, end) in order."""
    plain = identifiers(text)
    hidden = disguised(text, plain) if look_behind_disguises else []
    return plain, sorted({*plain, *hidden})


def described(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# characters below U+0240, the first that 0xC9 starts: those a transducer may take for
# another one or for a blank, and those that end a word
_LOW = [chr(i) for i in range(0x240)]
_ODD_LOW = np.array([not c.isascii() and (c.isspace() or c == "İ" or _plain_character(c) != c) for c in _LOW])
_APART_LOW = np.array([not c.isascii() and not c.isalnum() for c in _LOW])
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _hashes(words) -> np.ndarray:
    raw, offsets = text_buffers(pa.array(sorted({v for w in words for v in (w, "".join(c if c.isascii() else c.upper() for c in w))})))
    return np.sort(np.concatenate([spans(s, e) for s, e, spans, _ in word_blocks(raw, offsets, _APART)]))


def candidates(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which texts can hold plain identifiers, and which disguised ones.

    Necessary conditions on bytes and hashed words, so most texts are told clean by array
    operations: an at sign or two digits; else uncommon characters, three spelled digits,
    bracketed signs or dots, words for at and dot, at between underscores, or a letter
    like a digit beside one. Each transducer that would change a text has its condition
    met by that text.
    """
    raw, offsets = text_buffers(column)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(segments(mask)[offsets])

    def rows(starts: np.ndarray | list[int]) -> np.ndarray:
        places = np.searchsorted(offsets, np.asarray(starts, np.int64), side="right") - 1
        return np.bincount(places, minlength=len(offsets) - 1)

    digit = (raw >= 48) & (raw <= 57)
    at_sign, digits = count(raw == 64), count(digit)
    odd, parted = raw >= 0xC9, raw
    low = np.flatnonzero((raw >= 0xC2) & ~odd)
    if len(low):
        codes = (raw[low] & 0x1F).astype(np.int64) << 6 | raw[low + 1] & 0x3F
        odd[low] = _ODD_LOW[codes]
        apart, parted = low[_APART_LOW[codes]], raw.copy()
        parted[apart] = parted[apart + 1] = 0x20
    sets = [_hashes(_DIGIT_WORDS), _hashes(_DOT_WORDS), _hashes(_AT_WORDS)]
    seen = np.zeros((3, len(offsets) - 1), np.int64)
    for s, e, spans, at in word_blocks(parted, offsets, _APART):
        hashes = spans(s, e)
        for k, known in enumerate(sets):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            seen[k] += rows(s[known[place] == hashes] + at)
    bracket = count(np.isin(raw, np.frombuffer(b"[({<", np.uint8)))
    beside = np.zeros(len(raw), bool)
    beside[1:] = digit[:-1] & np.isin(raw[1:], np.frombuffer(b"OolI", np.uint8))
    beside[:-1] |= digit[1:] & np.isin(raw[:-1], np.frombuffer(b"OolI", np.uint8))
    hidden = (
        (count(odd) > 0)
        | (seen[0] >= 3)
        | (at_sign > 0)
        | (seen[1] >= 3)
        | ((bracket > 0) & ((seen[1] > 0) | (seen[2] > 0)))
        | (rows([m.start() for m in _BARE_DOT.finditer(raw)]) > 0)
        | ((seen[2] > 0) & (seen[1] > 0))
        | (rows([m.start() for m in _JOINED_AT.finditer(raw)]) > 0)
        | (count(beside) > 0)
    )
    return (at_sign > 0) | (digits >= 2), hidden


def find_in_batch(column: pa.Array) -> list[tuple[list, list]]:
    plain, hidden = candidates(column)
    nothing: tuple[list, list] = ([], [])
    return [
        find(column[i].as_py() or "", bool(hidden[i])) if plain[i] or hidden[i] else nothing for i in range(len(column))
    ]


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): what it holds and where.

    ``spans`` lists all spans as kind:start:end in code points, by start, then kind; the
    n_ columns count them by kind. ``base_sha256`` is the hash of the like list of plain
    identifiers alone, which ``spans`` always contains. Null text is empty. Equal rows are
    told alike; a null doc_id is kept. No rows give no rows; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = find_in_batch(batch.column(1))
            counts = [[sum(k == kind for _, k, _ in spans) for _, spans in got] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(described(plain).encode()).hexdigest() for plain, _ in got]),
                    pa.array([described(spans) for _, spans in got]),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlaps joined, replaced by its kind in brackets."""
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the identifiers in ``text`` replaced; all columns and rows kept."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column(place)
            got = find_in_batch(column)
            changed = [redact(column[i].as_py(), spans) if spans else column[i].as_py() for i, (_, spans) in enumerate(got)]
            arrays = list(batch.columns)
            arrays[place] = pa.array(changed, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return arrow_map(docs, run, docs.schema)
