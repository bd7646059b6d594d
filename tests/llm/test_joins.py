"""The joins and searches against brute force."""

import random

import numpy as np
import pytest
from tests.llm.helpers import documents, pages, words

from sedimenta.llm import near_vectors, ngram_join, topk
from sedimenta.llm.components import connected_components


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_join(rows, width, percent):
    sets = {i: shingles(t, width) for i, t, _ in rows}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    comp = components(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}


@pytest.mark.parametrize("leaf,pivots,width,percent", [(1000, 32, 4, 85), (6, 3, 5, 80), (4, 2, 2, 50)])
def test_ngram_join(spark, monkeypatch, leaf, pivots, width, percent):
    monkeypatch.setattr(ngram_join, "LEAF_NODES", leaf)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    rng = random.Random(leaf)
    texts = pages(rng, 150) + ["", None, " \t\n", "one", "One", "a b c", "a B c", "x " * 3000, "x " * 2999]
    rows = [(i * 3, t, "s") for i, t in enumerate(texts)]
    found = ngram_join.similar_components(documents(spark, rows), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_join(rows, width, percent)


def test_blocks_of_few_long_documents(spark):
    rows = spark.createDataFrame([(7, i, 100_000, i) for i in range(500)], "region long, node long, n long, label long")
    sizes = ngram_join._sized(rows)
    assert [r.leaf for r in sizes.collect()] == [False]
    blocks = {}
    for r in ngram_join._blocks(rows, sizes).distinct().collect():
        blocks.setdefault(r.region, {})[r.node] = r.n
    met = {(a, b) for nodes in blocks.values() for a in nodes for b in nodes if a < b}
    assert len(met) == 500 * 499 // 2
    # dealt by hash, so a pair of blocks holds LEAF_SHINGLES on average
    assert max(sum(nodes.values()) for nodes in blocks.values()) <= 2.5 * ngram_join.LEAF_SHINGLES


def test_sketches_leave_no_link_out():
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(120):
        x = rng.integers(0, 1 << 63, int(rng.integers(1, 900)), dtype=np.uint64)
        for _ in range(3):
            more = rng.integers(0, 1 << 63, int(rng.integers(0, max(1, len(x) // 5) + 1)), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([x[int(rng.integers(0, max(1, len(x) // 10))) :], more])))
    n = np.array([len(s) for s in sets])
    packed = ngram_join.sketches(np.concatenate(sets), n)
    group = ngram_join.look_alikes(packed, n, np.arange(len(n)), 80)
    shared = [set(s.tolist()) for s in sets]
    links = [(i, j) for i in range(len(n)) for j in range(i)
             if 100 * len(shared[i] & shared[j]) >= 80 * len(shared[i] | shared[j])]
    assert len(links) > 50 and all(group[i] == group[j] >= 0 for i, j in links)
    assert len(np.unique(group[group >= 0])) >= 60 and (group == -1).any()
    one = np.zeros(len(n), np.int64)
    assert (ngram_join.look_alikes(packed, n, one, 80) == -1).all()


@pytest.mark.parametrize("nodes", [3, 50])
def test_ngram_join_in_blocks_of_sketches(spark, monkeypatch, nodes):
    monkeypatch.setattr(ngram_join, "SKETCH_NODES", nodes)
    rows = [(i, t, "s") for i, t in enumerate(pages(random.Random(nodes), 80))]
    found = ngram_join.similar_components(documents(spark, rows), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_join(rows, 4, 85)


def test_cut_of_near_copies_makes_few_rows(spark, monkeypatch):
    """Cells cannot tell near copies apart: rows would grow with the cells and with every cut."""
    monkeypatch.setattr(ngram_join, "LEAF_NODES", 100)
    rng = random.Random(11)
    # each is a heart but for words of its own: chains of links, and outsiders just beyond one
    heart = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        copy = list(heart)
        for k in rng.sample(range(120), rng.choice([1, 2, 2, 3, 6])):
            copy[k] = f"v{i}-{k}"
        rows.append((i, " ".join(copy), "s"))
    made, leaf_edges = [], ngram_join._leaf_edges

    def counted(regions, *rest):
        made.append(regions.count())
        return leaf_edges(regions, *rest)

    monkeypatch.setattr(ngram_join, "_leaf_edges", counted)
    found = ngram_join.similar_components(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_join(rows, 4, 85)
    assert max(made) > 0 and sum(made) <= 15 * len(rows)


def test_blocks_leave_out_pairs_of_the_commonest_label(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF_NODES", 40)
    label = {i: 0 if i % 10 else i for i in range(400)}
    rows = spark.createDataFrame([(7, i, 5, v) for i, v in label.items()], "region long, node long, n long, label long")
    blocks, made = {}, 0
    for r in ngram_join._blocks(rows, ngram_join._sized(rows)).collect():
        blocks.setdefault(r.region, set()).add(r.node)
        made += 1
    met = {(a, b) for nodes in blocks.values() for a in nodes for b in nodes if a < b}
    assert {(a, b) for a in label for b in label if a < b and label[a] != label[b]} <= met
    assert made <= 5 * len(label) and max(map(len, blocks.values())) <= 80


def test_local_join_is_exact():
    rng = np.random.default_rng(12)
    for percent in (50, 85):
        heart = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        sets = [np.unique(np.concatenate([heart[: int(rng.integers(1, 300))], rng.integers(0, 1 << 63, int(rng.integers(0, 40)), dtype=np.uint64)])) for _ in range(90)]
        label = rng.integers(0, 80, 90)
        shared = [set(s.tolist()) for s in sets]
        links = [(i, j) for i in range(90) for j in range(i) if label[i] == label[j]
                 or 100 * len(shared[i] & shared[j]) >= percent * len(shared[i] | shared[j])]
        want, got = components(range(90), links), ngram_join.local_join(sets, label, percent)
        assert len({(want[i], got[i]) for i in range(90)}) == len(set(want.values())) == len(set(got.tolist()))


def test_ngram_join_of_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e", "s"), (5, "a b c d e", "s"), (5, "q r s t u", "s"), (None, "a b c d e", "s"), (9, "q r s t u", "s")]
    found = ngram_join.similar_components(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found) == [
        ("5", 2, 5), ("5", 2, 5), ("5", 2, 5), ("9", 2, 5), ("None", 2, 5)
    ]
    assert ngram_join.similar_components(documents(spark, [])).count() == 0
    kept = ngram_join.one_of_each(documents(spark, rows), 4, 85)
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("5", "a b c d e"), ("5", "q r s t u"), ("None", "a b c d e")
    ]
    assert kept.columns == documents(spark, []).columns


def test_parts_of_linked_sets_meet():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(6, 400))
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        drop = int(rng.integers(0, max(1, n * 15 // 200) + 1))
        y = np.concatenate([x[drop:], rng.integers(0, 1 << 63, drop, dtype=np.uint64)])
        both = len(set(x.tolist()) & set(y.tolist()))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        row, key = ngram_join.part_keys(np.concatenate([np.sort(x), np.sort(y)]), np.array([n, n]), 85)
        assert (x == y).all() or set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in found} == components(nodes, links)
    assert len(found) == len(nodes)


VECTORS = "vec_id long, embedding array<float>, label int, score long, node long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 1) for i, v, label in rows], VECTORS)


ODD = [
    (900, None, 1), (950, [1.0, None, 0.0], 1), (951, [1.0, float("nan"), 0.0], 1), (952, [1.0, float("inf"), 0.0], 1),
    (953, [0.0, 0.0, 0.0], 1), (954, [0.5, 0.5, 0.5], None), (955, [], 1), (None, [0.5, 0.5, 0.5], 1),
]


@pytest.mark.parametrize("blocks", [(1024, 4096), (2, 7)])
def test_top_inner_products(spark, blocks):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3) / 7], 0) for i in range(0, 600, 5)] + ODD
    found = topk.top_inner_products(vectors(spark, rows), query_block=blocks[0], candidate_block=blocks[1]).collect()
    good = {i: np.floor(256 * np.float32(v).astype(float)).astype(int) for i, v, _ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in good:
        if q % 50 == 0:
            order = sorted((-int(good[q] @ x), i) for i, x in good.items() if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(order)}
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_top_inner_products_of_little(spark):
    assert topk.top_inner_products(vectors(spark, [])).count() == 0
    assert topk.top_inner_products(vectors(spark, [(50, [1.0], 1)])).count() == 0
    few = topk.top_inner_products(vectors(spark, [(50, [1.0], 1), (1, [2.0], 1), (1, [2.0], 1), (2, [1.0, 1.0], 1)]))
    assert [tuple(r) for r in few.collect()] == [(50, 1, 1, 131072)]


def test_bounds_keep_the_best():
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (500, 8)) ** 3
    q = rng.integers(-50, 50, (20, 8)) ** 3
    alive = topk.survivors(q, x, 5, np.full(20, -np.inf))
    best = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :5]
    assert alive[np.arange(20)[:, None], best].all() and not alive.all()


def test_only_pairs_alive_are_scored(monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.integers(-50, 50, (500, 8)) ** 3
    ids, q = np.arange(1000, 1020), rng.integers(-50, 50, (20, 8)) ** 3
    alive = topk.survivors(q, x, 6, np.full(20, -np.inf))
    scored, exact = [], topk._exact
    monkeypatch.setattr(topk, "_exact", lambda a, b: scored.append(len(a) * len(b)) or exact(a, b))
    best = topk._Best(ids, q, 5)
    best.add(np.arange(500), x)
    assert sum(scored) == alive.sum() < alive.size
    assert [f.tolist() for f in best.found] == np.lexsort((np.tile(np.arange(500), (20, 1)), -(q @ x.T)), axis=1)[:, :5].tolist()


def best_by_hand(rows, k):
    """rows: (id, integers). Every score as a Python integer held at 64 bits, ties to the smaller id."""
    held = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = set()
    for q, v in rows:
        if q % 50 == 0:
            order = sorted((-held(sum(a * b for a, b in zip(v, w, strict=True))), i) for i, w in rows if i != q)[:k]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(order)}
    return want


def test_blocks_meet_without_copies_in_an_exchange(spark, monkeypatch):
    """Copies of blocks made before an exchange grow with the square of the table: 13 times the input at 0.16 GB."""
    plans, arrow_map = [], topk.arrow_map

    def watched(df, fn, schema):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        if "score" not in schema:
            return arrow_map(df, fn, schema)

        def alone(batches):
            def each():
                for batch in batches:
                    assert batch.num_rows <= 1, "several pairs of blocks at once"
                    yield batch

            return fn(each())

        return arrow_map(df, alone, schema)

    monkeypatch.setattr(topk, "arrow_map", watched)
    rng = np.random.default_rng(13)
    rows = [(i, rng.integers(-9, 10, 3).tolist()) for i in range(0, 700, 2)]
    data = vectors(spark, [(i, [float(x) for x in v], 0) for i, v in rows])
    found = topk.top_inner_products(data, scale=1, query_block=3, candidate_block=16)
    assert {tuple(r) for r in found.collect()} == best_by_hand(rows, 5)
    assert plans and not any("Generate" in p for p in plans)


def test_top_inner_products_of_copies_and_of_large_values(spark):
    """Many equal rows, and scores that floats round or that 64 bits cannot hold."""
    rng = random.Random(14)
    heart, far = [3, -2, 5], [1 << 55, -(1 << 54), 1 << 40]
    rows = [(i, list(heart)) for i in range(0, 400, 5)] + [(i, list(far)) for i in range(2, 60, 5)]
    rows += [(i, [rng.randrange(-(1 << e), 1 << e) for _ in range(3)]) for e in (4, 13, 28, 31) for i in range(1000 + 50 * e, 1000 + 50 * e + 51, 5)]
    data = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    for blocks in ((64, 4096), (2, 9)):
        found = topk.top_inner_products(data, scale=1, query_block=blocks[0], candidate_block=blocks[1])
        assert {tuple(r) for r in found.collect()} == best_by_hand(rows, 5)


def test_bounds_of_a_block_spare_its_queries():
    """Queries that the ends of the lists, or the longest row, keep under their bar cost no product."""
    rng = np.random.default_rng(15)
    x, q = rng.integers(-20, 21, (300, 6)), rng.integers(-20, 21, (40, 6))
    scores = q @ x.T
    floor = np.sort(scores, axis=1)[:, -3].astype(float)
    floor[::2] = np.sqrt((q[::2] ** 2).sum(axis=1)) * np.sqrt((x**2).sum(axis=1).max()) + 1
    alive = topk.survivors(q, x, 4, floor)
    assert (alive == (scores >= floor[:, None])).all() and not alive[::2].any()


def test_order_of_blocks_does_not_matter():
    rng = np.random.default_rng(16)
    x = np.repeat(rng.integers(-7, 8, (60, 4)), 9, axis=0)
    ids, q = rng.permutation(len(x)), rng.integers(-7, 8, (33, 4))
    want = np.lexsort((np.tile(ids, (33, 1)), -(q @ x.T)), axis=1)[:, :5]
    for size in (1, 7, 100, 540):
        best = topk._Best(np.arange(1000, 1033), q, 5)
        for i in rng.permutation(range(0, len(x), size)):
            best.add(*topk._without_copies(ids[i : i + size], x[i : i + size], 6))
        assert (best.found == ids[want]).all() and (best.scores == np.take_along_axis(q @ x.T, want, axis=1)).all()


@pytest.mark.parametrize("block", [2048, 5])
def test_near_duplicate_vectors(spark, block):
    rng = np.random.default_rng(7)
    heart = rng.standard_normal((12, 16))
    rows = []
    for i in range(300):
        v = heart[i % 12] + rng.standard_normal(16) * rng.choice([0.0, 0.02, 0.08, 0.4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 2))
    rows += [(i, v * 5 + [0.1] if v and len(v) == 3 and None not in v else v, k) for i, v, k in ODD]
    good = [(i, np.array(v, float), k) for i, v, k in rows if i is not None and k is not None and v
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for a, v, k in good for b, w, m in good
             if a < b and k == m and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98]
    ids = [i for i, _, _ in rows if i is not None]
    comp = components(ids, links)
    n = {i: sum(i in pair for pair in links) for i in ids}
    found = near_vectors.near_duplicate_vectors(vectors(spark, rows), block=block).collect()
    assert len(found) == len(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found if r.vec_id is not None}
    assert sum(got[i][0] for i in ids) >= 0.99 * sum(n.values()) > 0
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in ids}
    assert near_vectors.near_duplicate_vectors(vectors(spark, [])).count() == 0
