"""Scores, identifiers, records, packing, mixing and the language model."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import documents, pages, words
from tokenizers import Tokenizer

from sedimenta.llm import katz, mixing, packing, pii, quality, queries, records, toxicity
from sedimenta.llm.tokens import encoder, vocabulary_path

ODD_TEXTS = ["", None, " \n\t ", "one", "é²5 ½x_y __a", "a  b\n\n c", "it's <|endoftext|> x", "long " * 30_000, "\x1c \x85"]


def labelled(spark, make, n=240):
    rng = random.Random(1)
    rows = [(i, make(rng, i % 3 == 0), "s") for i in range(n)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD_TEXTS)] + [(None, "a word", "s"), (0, rows[0][1], "s")]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(n)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    return documents(spark, rows), labels


def check_scores(docs, labels, scored, target, least):
    rows = scored.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) for r in rows)
    truth = {r.doc_id: r[target] for r in labels.collect() if r[target] is not None}
    held = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean(held) >= least
    same = [r.score for r in rows if r.doc_id == 0]
    assert len(same) == 2 and same[0] == same[1]


def test_toxicity_learns_pairs(spark):
    """Neither word is toxic alone; both together are."""

    def make(rng, toxic):
        text = [f"w{rng.randrange(40)}" for _ in range(rng.randint(3, 40))]
        other = rng.random()
        text += ["vile", "group"] if toxic else ["vile"] if other < 0.4 else ["group"] if other < 0.8 else []
        rng.shuffle(text)
        return " ".join(text)

    docs, labels = labelled(spark, make, 900)
    check_scores(docs, labels, toxicity.score_documents(docs, labels), "toxic", 0.9)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 500 < kept.count() < docs.count()


def test_quality(spark):
    def make(rng, bad):
        text = [f"word{rng.randrange(999)}" for _ in range(rng.randint(5, 60))]
        return " | ".join(text[:4] * 8) if bad else " ".join(text)

    docs, labels = labelled(spark, make)
    check_scores(docs, labels, quality.score_documents(docs, labels), "quality", 0.95)


def test_quality_learns_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    label = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x[:2000], label[:2000])
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert np.mean((model.logits(x[2000:]) > 0) == label[2000:]) > 0.93


@pytest.mark.parametrize("scorer", [toxicity, quality])
def test_scores_without_labels(spark, scorer):
    docs, labels = labelled(spark, lambda rng, _: "some text", 6)
    assert {r.predicted for r in scorer.score_documents(docs, labels.limit(0)).collect()} <= {0, 1}
    assert scorer.score_documents(docs.limit(0), labels).count() == 0


def brute_identifiers(text):
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= sum(c.isdigit() for c in s) <= 19 and luhn(s)),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= sum(c.isdigit() for c in s) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0]))


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def test_plain_identifiers():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("aB_1234567890.@+- ()\n5.@") for _ in range(rng.randint(0, 60)))
        assert pii.identifiers(text) == brute_identifiers(text)
    assert pii.identifiers("card 4111 1111 1111 1111.") == [(5, 2, 24)]
    assert pii.identifiers("1" * 200_000 + ".1" * 1000) is not None


@pytest.mark.parametrize(
    "text,kind",
    [
        ("john (at) example (dot) com", "email"), ("john [AT] mail.example.com", "email"),
        ("john dot doe at example dot co dot uk", "email"), ("jоhn@exаmple.com", "email"), ("ｊohn＠example．com", "email"),
        ("jo​hn@exam­ple.com", "email"), ("john_at_example_dot_com", "email"), ("ann @ mail.example.com", "email"),
        ("plus one five five five one two three four five six seven", "phone"), ("+1 (0l7) 555-77l3", "phone"),
        ("one nine two dot one six eight dot zero dot one", "ip"), ("１９２．168.0.1", "ip"), ("10(dot)0(dot)0(dot)1", "ip"),
        ("four one one one one one one one one one one one one one one one", "card"),
        ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card"),
    ],
)
def test_disguises(text, kind):
    for before, after in (("", ""), ("see ", " now"), ("é… ", "; é")):
        whole = before + text + after
        spans = pii.find(whole)[1]
        assert (len(before), pii.KINDS.index(kind), len(before) + len(text)) in spans
        assert pii.find_in_batch(pa.array([whole])) == [pii.find(whole)]
        assert text not in pii.redact(whole, spans)


BLANKS = ("", " ", "\t ", "\x1c", "\x85", "\xa0")


def bracketed(signs):
    return [f"{b}{a}{x}{sign}{x}{z}{b}" for a, z in ("[]", "()", "{}", "<>", "[)") for x in BLANKS for b in ("", " ") for sign in signs]


def disguises(form):
    """Texts of one form of disguise with nothing else in them."""
    dots, ats = [*pii._DOT_WORDS, "PUNKT"], ["at", "AT", "arroba", "ät", "ÄT"]
    if form == "bare dot":
        return [f"192{d}168{d}0{d}1" for d in bracketed(".")] + [f"192{d}168.0.1" for d in bracketed(".")]
    if form == "dot in brackets":
        return [f"10{d}0.0.1" for d in bracketed([*dots, "poİnt"])]
    if form == "at in brackets":
        return [f"john{a}mail.example.com" for a in bracketed([*ats, "chez", "@"])]
    if form == "joined":
        domains = ["example.com", "mail.example.co.uk", *(f"example_{d}_com" for d in dots), *(f"mail.example_{d}_com" for d in dots)]
        return [f"{n}_{a}_{d}" for n in ("john", "a.b+c", "x_at") for a in [*ats, "chez"] for d in domains]
    if form == "words":
        return [f"john{x}{a}{x}example{x}{d}{x}com" for x in BLANKS[1:] for a in ats for d in dots]
    if form == "characters":
        every = [c for c in map(chr, range(0x80, 0x3000)) if pii._plain_character(c) != c]
        return [f"{c}.20.30.40" for c in every] + [f"a{c}1.20.30.40" for c in every]
    if form == "mixed":
        short = [f"{x}.2.3.4" for x in ("1O", "l0", "I9", "2o", "1º", "1l2")] + [f"1.2.3.{x}" for x in ("1O", "l0", "I9", "2o")]
        return [*short, "+1O2O3O4O5O", "+l2O3O4O5O6", "4l1l1l1l1l1l1l1l", "l0.l0.l0.l0"]
    if form == "spelled":
        words = list(pii._DIGIT_WORDS)
        runs = [" ".join((w, "23456789", v, w)) for w in words for v in (w.upper(), w.replace("i", "İ"), w.replace("s", "ſ"))]
        return [f"{a}plus {r}{z}" for r in runs for a, z in ("  ", "«»", "×÷", "¿?")]
    raise ValueError(form)


@pytest.mark.parametrize("form", ["bare dot", "dot in brackets", "at in brackets", "joined", "words", "characters", "mixed", "spelled"])
def test_batches_find_every_disguise(form):
    texts = disguises(form)
    expected = [pii.find(t) for t in texts]
    assert sum(spans != plain for plain, spans in expected) > len(texts) / 20
    assert pii.find_in_batch(pa.array(texts)) == expected
    assert [pii.find_in_batch(pa.array([t]))[0] for t in texts] == expected


def test_joined_at_beside_a_row_border():
    texts = ["see x_a", "t_at_example.com", "mail john_", "at_example.com", "", "john_at_example.com"]
    assert pii.find_in_batch(pa.array(texts)) == [pii.find(t) for t in texts]
    assert [spans for _, spans in pii.find_in_batch(pa.array(texts))][1] == [(0, 0, 16)]


@pytest.mark.parametrize("text", ["look at the dot on the map", "il est chez le point de la", "one two three go", "I am at home at five", "l0ve Ol0", ""])
def test_clean_texts_stay(text):
    assert pii.find(text) == ([], [])


def test_personal_data_rows(spark):
    rows = [(i, t, None) for i, t in enumerate([*ODD_TEXTS, "a@b.cd 1.2.3.4", "a@b.cd 1.2.3.4"])] + [(None, "a@b.cd", "s")]
    found = {(r.doc_id, r.spans): r for r in pii.find_personal_data(documents(spark, rows)).collect()}
    assert found[(9, "email:0:6,ip:7:14")].n_ip == 1 and found[(None, "email:0:6")].n_email == 1
    assert len(found) == len(rows)
    redacted = pii.redact_documents(documents(spark, rows))
    assert redacted.columns == documents(spark, []).columns
    assert sorted(str(r.text) for r in redacted.collect())[-3:] != [] and redacted.where("text = '[EMAIL] [IP]'").count() == 2
    assert pii.find_personal_data(documents(spark, [])).count() == 0


def test_encoder_equals_the_library():
    own, library = encoder(vocabulary_path()), Tokenizer.from_file(vocabulary_path())
    rng = random.Random(3)
    texts = [*ODD_TEXTS, "日本語 テスト", "«a».b", "don't 'tis  x", "ab\ncd.ef,gh", " lead", "trail "]
    texts += ["".join(rng.choice("abé ß1.,'\n _-") for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    ids, counts = own.encode_column(pa.array(texts))
    at = np.concatenate([[0], np.cumsum(counts)])
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def brute_crc(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_record_frames():
    rng = random.Random(4)
    bodies = [rng.randbytes(n) for n in (0, 1, 2, 3, 4, 5, 255, 256, 257, 1000)] + [b"123456789"]
    assert records.crc32c(bodies).tolist() == [brute_crc(b) for b in bodies]
    assert brute_crc(b"123456789") == 0xE3069283
    framed = records.frame(bodies)
    at = np.cumsum([0, *map(len, framed)])[:-1].tolist()
    data, sizes = b"".join(framed), [len(f) for f in framed]
    assert records.unframe(data, at, sizes) == bodies
    for place in (at[9] + 3, at[9] + 500, at[9] + 9):
        hurt = bytearray(data)
        hurt[place] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(hurt), at, sizes)


def test_record_round_trip(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i * 7 % 101, t, "s") for i, t in enumerate(pages(rng, 60))] + [(1000 + i, t, "s") for i, t in enumerate(ODD_TEXTS)]
    docs = documents(spark, rows)
    library = Tokenizer.from_file(vocabulary_path())
    start = 0
    want = []
    for i, t, _ in sorted(rows):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in records.record_digest(docs).collect()) == want
    folder = f"file://{tmp_path}/records"
    index = records.write_records(docs, folder)
    some = records.read_records(index.where("doc_id % 3 = 0").orderBy(F.desc("doc_id")), folder).collect()
    assert {(r.doc_id, len(r.ids) // 2) for r in some} == {(i, n) for i, _, n, _ in want if i % 3 == 0}
    assert records.record_digest(documents(spark, [])).count() == 0
    assert records.record_digest(documents(spark, [(None, "b", "s"), (1, "a", "s"), (1, "a", "s")])).count() == 3


def test_lower_bound_holds():
    rng = np.random.default_rng(6)
    for _ in range(300):
        sizes = rng.integers(1, 21, rng.integers(1, 9))
        assert packing.lower_bound(sizes, 20) <= fewest(sorted(sizes.tolist(), reverse=True), 20, [])
    assert packing.lower_bound(np.array([11] * 7), 20) == 7
    assert packing.lower_bound(np.zeros(0, int), 20) == 0


def fewest(sizes, capacity, bins):
    if not sizes:
        return len(bins)
    best = fewest(sizes[1:], capacity, [*bins, sizes[0]])
    for i in range(len(bins)):
        if bins[i] + sizes[0] <= capacity and bins[i] not in bins[:i]:
            best = min(best, fewest(sizes[1:], capacity, [*bins[:i], bins[i] + sizes[0], *bins[i + 1 :]]))
    return best


@pytest.mark.parametrize("group_items", [50_000, 25])
def test_packing(spark, group_items):
    rng = random.Random(7)
    rows = [(i, t, "s") for i, t in enumerate([*pages(rng, 300), *ODD_TEXTS])] + [(None, "x y", "s"), (1, "again", "s")]
    docs = documents(spark, rows)
    library = Tokenizer.from_file(vocabulary_path())
    got = packing.pack_sequences(packing.token_pieces(docs, 128), 128, group_items).toPandas()
    want = collections.Counter()
    for i, t, _ in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 128 or 128, len(ids) + 1, 128)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    none = lambda r: (None if math.isnan(r[0]) else int(r[0]), *map(int, r[1:]))
    assert collections.Counter(map(none, got[columns].values.tolist())) == want
    for _, rows_of in got.sort_values("offset").groupby("sequence_id"):
        ends = rows_of.length.cumsum()
        assert rows_of.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= 128
    bound = packing.lower_bound(got.length.to_numpy(), 128)
    assert got.sequence_id.nunique() <= bound + (1 if group_items > len(got) else bound // 20)
    assert packing.pack_documents(documents(spark, [])).count() == 0


@pytest.mark.parametrize("bucket_rows", [2000, 7])
def test_mixing_equals_sql(spark, bucket_rows):
    rng = random.Random(8)
    rows = [(i, t, rng.choice(["a", "a", "a", "b", "Ç", None])) for i, t in enumerate([*pages(rng, 200), *ODD_TEXTS])]
    rows += [(None, "one two", "b"), (7, "three four", "a"), (7, "three four", "a"), (999, "", "empty")]
    docs = documents(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    cursor = con.execute(queries.ORACLES["op6_mix_sources"])
    names = [d[0] for d in cursor.description]
    found = mixing.mix_sources(docs, bucket_rows=bucket_rows).select(*names).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(cursor.fetchall(), key=repr)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert sum(r.taken for r in own) == math.floor(own[0].target) and all(r.taken <= 2 * r.size for r in own)
    mixed = mixing.mixed_documents(docs, bucket_rows=bucket_rows)
    assert mixed.columns == docs.columns
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(words(r.text))
    want = collections.Counter()
    for r in found:
        want[r.doc_id] += r.taken
    assert +taken == +want
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def brute_katz(rows):
    texts = [(i, [*words(t), "</s>"]) for i, t, _ in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    one, two = collections.Counter(), collections.Counter()
    starts = 0
    for i, w in texts:
        if not held(i):
            one.update(w)
            two.update(zip(["<s>", *w], w))
            starts += 1
    total, d = sum(one.values()), []
    for c in (one, two):
        d.append(katz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)]))
    cut = lambda k, r: d[k][r if r <= 5 else 0]
    share = {w: cut(0, c) * c / total for w, c in one.items()}
    unknown = 1 - sum(share.values()) if one else 1.0
    size = dict(one) | {"<s>": starts}
    left, mass = collections.Counter(), collections.Counter()
    for (h, w), r in two.items():
        left[h] += (1 - cut(1, r)) * r
        mass[h] += share[w]

    def p(h, w):
        r = two.get((h, w), 0)
        if r:
            return cut(1, r) * r / size[h]
        weight = left[h] / size[h] / (1 - mass[h]) if h in left else 1.0
        return weight * share.get(w, unknown)

    return texts, one, total, p, held


def test_katz(spark, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 1500)
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 2500)
    rng = random.Random(9)
    rows = [(i, t, "s") for i, t in enumerate([*pages(rng, 200, 60), *ODD_TEXTS])] + [(None, "w1 w2", "s"), (3, "w1 new", "s")]
    texts, one, total, p, held = brute_katz(rows)
    found = sorted(map(tuple, katz.score_documents(documents(spark, rows)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)
    want = sorted(
        (
            (i, held(i), len(w), sum(x in one for x in w), total,
             sum(math.log10((one[x] + 0.5) / (total + 0.5 * (len(one) + 1))) for x in w),
             sum(math.log10(p(h, x)) for h, x in zip(["<s>", *w], w)))
            for i, w in texts
        ),
        key=repr,
    )
    assert len(found) == len(want)
    for a, b in zip(found, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
    for h in ("<s>", "w1", "long", "never"):
        assert sum(p(h, w) for w in one) + p(h, "an unknown word") == pytest.approx(1, abs=1e-9)


def test_katz_of_little(spark):
    assert katz.score_documents(documents(spark, [])).count() == 0
    assert katz.score_documents(documents(spark, [(1, None, None)])).first().n_tokens == 1


def test_mixing_of_equal_rows_and_clashing_names(spark):
    """A source of one row many times over, under columns named like the operator's own."""
    rows = [(None, "one two three", "a", i, 1, 2) for i in range(3000)] + [(i, "x y", None, i, 1, 2) for i in range(50)]
    rows += [(7, "b c d e", "b", 1, 1, 1), (7, "f g h i", "b", 2, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_nth long, extra int, `last` int")
    docs = docs.withColumns({"row": F.lit(1), "cut": F.lit(2), "of": F.lit("z"), "a.b": F.lit(3), "place": F.lit(4)})
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = mixing.mix_sources(docs).collect()
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
    for source in (None, "a", "b"):
        assert taken[source] == sum(r.taken for r in found if r.source == source)
    assert not mixing.mixed_documents(docs.limit(0)).collect()
