"""Phrases, quality rules and whitening against plain versions of themselves."""

import collections
import math
import random
import re

import numpy as np
import pytest
from tests.llm.helpers import WORDS

from sedimenta.llm import collocations, rules, whitening

ODD = ["", None, " \n\t ", "one", "...;", "a b c", "é²5 ½x_y", "Zero\x1cwidth \x85 x", "tab\tand  blanks", "W " * 20_000]


def docs(spark, rows):
    """(doc_id, text, lang) with columns named like the operators' own."""
    data = [(i, t, g, 1, 1, "x", [1], 2) for i, t, g in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, n long, a long, words string, counts array<int>, blank long")


# -- phrases


def plain_phrases(rows, support, longest, listed, covered_percent=100):
    count = collections.defaultdict(collections.Counter)
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        inside = {}
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), a)
        kept = []
        for p, a in found.items():
            if 100 * inside.get(p, 0) >= covered_percent * a:
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:listed], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.mark.parametrize(("support", "longest", "listed", "bits", "chunk"), [(3, 5, 2000, 26, 1 << 20), (2, 4, 7, 6, 300), (5, 2, 3, 26, 1)])
def test_phrases(spark, monkeypatch, support, longest, listed, bits, chunk):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rng = random.Random(support)
    marks = [" ", "  ", "\t", ". ", ", ", "\n", ";", " x! "]
    rows = [
        (i, "".join(rng.choice(("New", "new", "york", "city", "ß", "of", "the", "big")) + rng.choice(marks[: 3 + i % 6]) for _ in range(rng.randint(0, 40))), lang)
        for i in range(120)
        for lang in (rng.choice(("en", "de", "und", None, "")),)
    ]
    rows += [(None, t, rng.choice(("en", None))) for t in ODD] + [rows[0]] * 9
    got = collocations.mine_phrases(docs(spark, rows), support, longest, listed, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, support, longest, listed)


def test_covered_phrases_by_share(spark):
    rows = [(i, "a b c" if i % 3 else "a b", "en") for i in range(30)]
    got = {r.phrase for r in collocations.mine_phrases(docs(spark, rows), 5, covered_percent=60).collect()}
    assert got == {p[2] for p in plain_phrases(rows, 5, 5, 2000, 60)} == {"a b c"}


def test_phrases_of_nothing(spark):
    for rows in ([], [(1, None, None), (2, " . ", "en")], [(1, "rare words", "en")]):
        df = collocations.mine_phrases(docs(spark, rows))
        assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and not df.collect()


def test_long_counts_are_exact(spark):
    """Scores whose products pass 64 bits."""
    a, n, l, r = 3_000_000_000, 9_000_000_000_000, 4_000_000_000, 5_000_000_001
    df = spark.createDataFrame([(a, n, [l, a], [r, a])], "a long, n long, starts array<long>, ends array<long>")
    assert df.select(collocations._weakest_cut(2).alias("c")).first().c.score == 1000 * a * n // (l * r)


# -- rules


def plain_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def distance(p, q):
    part = lambda x, y: x * math.log2(2 * x / (x + y)) if x > 0 else 0.0
    return math.sqrt(max(sum(part(x, y) + part(y, x) for x, y in zip(p, q)) / 2, 0))


def plain_distances(rows, common_words):
    classes = [r"[a-z]", r"[\x20\x09-\x0D]", "[A-Z]", "[0-9]", r"[^\x00-\x7F]"]
    texts = [("und" if g is None else g, t or "") for _, t, g in rows]
    chars = lambda t: np.array([*(own := [len(re.findall(c, t)) for c in classes]), len(t) - sum(own)], float)
    by = collections.defaultdict(lambda: [np.zeros(6), collections.Counter(), 0])
    for g, t in texts:
        by[g][0] += chars(t)
        by[g][1].update(w for w in WORDS.findall(t) if len(w) <= rules.COMMON_LENGTH)
        by[g][2] += len(WORDS.findall(t))
    out = []
    for g, t in texts:
        total, count, n = by[g]
        words, own = WORDS.findall(t), chars(t)
        if len(words) < 50 or n < rules.MIN_LANGUAGE_WORDS:
            out.append((None, None))
            continue
        common = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0].encode()))[:common_words]]
        share = lambda c, m: [*(c[w] / m for w in common), 1 - sum(c[w] for w in common) / m]
        word = distance(share(collections.Counter(words), len(words)), share(count, n))
        out.append((distance(own / own.sum(), total / total.sum()) if len(t) >= 200 else None, word))
    return out


@pytest.mark.parametrize("buckets", [4096, 1])
def test_common_words_may_be_long(spark, monkeypatch, buckets):
    monkeypatch.setattr(rules, "MIN_LANGUAGE_WORDS", 100)
    monkeypatch.setattr(rules, "LONG_BUCKETS", buckets, raising=False)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["together", "together", "the", f"rare{i}-{k}"]) for k in range(100 + i)), "en") for i in range(9)]
    rows.append((9, "the quick one " * 30 + "x y z", "en"))
    measured = rules.measures(docs(spark, rows))
    assert rules.language_references(measured, 2).first().common == ["together", "the"]
    got = {r.doc_id: r.word_distance for r in rules.rule_verdicts(docs(spark, rows), 2).collect()}
    with monkeypatch.context() as any_length:
        any_length.setattr(rules, "COMMON_LENGTH", 100)
        want = {i: w for (i, _, _), (_, w) in zip(rows, plain_distances(rows, 2))}
    assert got == pytest.approx(want, abs=1e-5) and got[9] > max(got[i] for i in range(9))


def test_rules(spark, monkeypatch):
    monkeypatch.setattr(rules, "MIN_LANGUAGE_WORDS", 1000)
    rng = random.Random(5)
    common, rare = ["the", "of", "and", "to", "in", "a"], [f"Word{i}" for i in range(300)]
    rows = []
    for i in range(150):
        share = 0.0 if i % 10 == 3 else 0.5
        words = [rng.choice(common) if rng.random() < share else rng.choice(rare) for _ in range(rng.choice((3, 49, 50, 51, 120, 400)))]
        text = "".join(w + rng.choice((" ", " ", "\n", "  ")) for w in words)
        rows.append((i, text if i % 17 else text + "#$%" * 400, rng.choice(("en", "en", None))))
    rows += [(None, t, "en") for t in ODD] + [(1, "same line here\n" * 80, "en"), (2, "x y z " + "x y z q " * 30, "fr"), rows[1], rows[1]]
    rows += [(3, " ".join(f"u{i}" for i in range(30_000)) + " u1 u2 u3 u4", "en")]
    got = rules.rule_verdicts(docs(spark, rows), 5).collect()
    want = [(i, *plain_measures(t), c, w) for (i, t, _), (c, w) in zip(rows, plain_distances(rows, 5))]
    near = lambda x: round(x, 4) if isinstance(x, float) else x
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed character_distance word_distance".split()
    assert sorted((tuple(near(r[c]) for c in names) for r in got), key=repr) == sorted((tuple(map(near, w)) for w in want), key=repr)
    for r in got:
        far = (r.character_distance or 0) > 0.35 or (r.word_distance or 0) > 0.25 + 1 / math.sqrt(max(r.n_words, 1))
        assert r.kept == (not r.base_failed and not far)
    assert {bool(r.kept) for r in got if not r.base_failed} == {True, False}


def test_rules_are_native(spark):
    df = rules.rule_verdicts(docs(spark, [(1, "a b c " * 20, "en")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert not rules.rule_verdicts(docs(spark, [])).collect()


# -- whitening


def vectors(spark, rows):
    data = [(i, v, "l", 1, [1.0], 2) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label string, component int, x array<double>, n long")


def check_whitened(rows, got, components=4):
    x = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in rows if v}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    kept = [j for j in range(min(components, len(values))) if values[j] > 1e-12 * values[0]]
    assert collections.Counter((r.vec_id, r.component) for r in got) == collections.Counter((i, j + 1) for i in x for j in kept)
    signs = {}
    for r in got:
        j, far = r.component - 1, n * x[r.vec_id] - sums
        want = far / n @ basis[:, j] / math.sqrt(values[j])
        if abs(want) > 1e-3:
            assert signs.setdefault(j, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
        assert abs(abs(r.whitened) - abs(want)) <= 1e-7 * max(1, abs(want))
        assert r.n == n and r.deviation == sum(int(v) ** 2 for v in far)
        assert abs(r.explained - values[j] / np.trace(cov)) <= 1e-9 and 0 <= r.identity_error <= 1e-9


@pytest.mark.parametrize("d", [1, 3, 8])
def test_whitening(spark, d):
    rng = np.random.default_rng(d)
    scale = 10.0 ** -np.arange(d)
    rows = [(i, list(map(float, rng.normal(size=d) * scale * 40 + 3))) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    bad = [(2000, None), (2001, [None] * d), (2002, [math.nan] * d), (2003, [math.inf] * d), (2004, []), (2005, [1.0] * (d + 1))]
    check_whitened(rows, whitening.whiten(vectors(spark, rows + bad)).collect())


def test_whitening_of_fewer_directions(spark):
    """Vectors in a plane have two components, equal ones none, and no rows give none."""
    rng = np.random.default_rng(0)
    plane = np.array([[1, 2, 0, -1, 3], [0, 1, 1, 4, -2]])
    rows = [(i, list(map(float, rng.integers(-9, 9, 2) @ plane))) for i in range(200)]
    check_whitened(rows, whitening.whiten(vectors(spark, rows)).collect())
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        df = whitening.whiten(vectors(spark, few))
        assert not df.collect() and df.columns[:3] == ["vec_id", "component", "n"]


def test_huge_entries(spark):
    rows = [(i, [float(3 ** i * 1e12), float(i), 0.5]) for i in range(8)]
    got = whitening.whiten(vectors(spark, rows), 1).collect()
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], object)
    for r in got:
        far = sum(int(v) ** 2 for v in 8 * x[r.vec_id] - x.sum(axis=0))
        assert r.deviation == (far if far < 1 << 63 else None)


def test_partial_sums_meet_in_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(4)
    rows = [(i, list(map(float, rng.normal(size=5)))) for i in range(90)]
    check_whitened(rows, whitening.whiten(vectors(spark, rows).repartition(9)).collect())
