"""Joins and components against brute force."""

import random

import numpy as np
import pytest

from strataflow.llm import embedding_pairs as E
from strataflow.llm import ngram_groups as N
from strataflow.llm.components import components


def roots_of(edges):
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x
    for a, b in edges:
        x, y = top(a), top(b)
        above[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(above)}


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + draw.randint(0, 200), 100 + draw.randint(0, 200)) for _ in range(150)] + [(500, 500)]
    edges += [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots_of([e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_sets(rows, size):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


@pytest.fixture(scope="module")
def families():
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    shared = " ".join(word() for _ in range(60))
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(draw.choice([2, 5, 12, 60, 150, 400]))]
        for _ in range(draw.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = word()
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i + k, shared + " " + " ".join(word() for _ in range(40))) for k in range(30)]
    rows += [(5000, None), (5001, ""), (5002, "One"), (5003, "one "), (5004, "one two"), (5005, "ONE\ttwo")]
    return rows


@pytest.mark.parametrize("rule, chunk", [(N.Rule(), 2048), (N.Rule(), 3), (N.Rule(5, 4, 5), 2048)])
def test_ngram_groups(spark, families, rule, chunk, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", chunk)
    sets = shingle_sets(families, rule.words)
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if rule.below * len(sets[a] & sets[b]) >= rule.above * len(sets[a] | sets[b])]
    want = roots_of(links)
    got = N.similar_documents(spark.createDataFrame(families, "doc_id long, text string"), rule).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want.get(i, i)) for i in sets}


def test_ngram_edges(odd_docs, clashing, no_docs):
    assert N.similar_documents(no_docs).count() == 0 and N.one_of_each(no_docs).count() == 0
    got = N.similar_documents(clashing).collect()
    assert len(got) == 12
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    kept = N.one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8, 9]


def test_ngram_null_ids(spark):
    words = [f"w{k}" for k in range(80)]
    near = [*words[:-1], "other"]
    rows = [(1, " ".join(words)), (None, " ".join(near)), (None, " ".join(near)), (None, "quite another text"), (7, "quite another text indeed"),
            *[(None, " ".join([*(f"v{k}" for k in range(80)), str(i)])) for i in range(3)], (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in N.similar_documents(docs).collect())
    assert got == [(-1, 0, -1)] * 2 + [(-1, 1, -1)] + [(-1, 78, 1)] * 2 + [(-1, 79, -1)] * 3 + [(1, 78, 1), (7, 2, 7)]
    kept = sorted((r.doc_id or -1, len((r.text or "").split())) for r in N.one_of_each(docs).collect())
    assert kept == [(-1, 0), (-1, 0), (-1, 3), (-1, 81), (1, 80), (7, 4)]


def test_one_of_each_judges_rows(spark):
    text = lambda c, n=80: " ".join(f"{c}{k}" for k in range(n))
    rows = [(1, text("a")), (1, text("b")), (2, text("c")), (3, text("c")), (3, text("d")), (4, text("e")), (4, text("e")), (4, text("e", 81))]
    kept = N.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text[0]) for r in kept) == [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]


def brute_vectors(rows, least):
    def valid(label, v):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ok = [k for k, (_, label, v) in enumerate(rows) if valid(label, v)]
    links = [(a, b) for n, a in enumerate(ok) for b in ok[n + 1:] if rows[a][1] == rows[b][1] and len(rows[a][2]) == len(rows[b][2])
             and np.dot(rows[a][2], rows[b][2]) / np.linalg.norm(rows[a][2]) / np.linalg.norm(rows[b][2]) >= least]
    roots = roots_of(links)
    least_of = {}
    for k in range(len(rows)):
        r = roots.get(k, k)
        least_of[r] = min(least_of.get(r, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], sum(k in e for e in links), least_of[roots.get(k, k)]) for k in range(len(rows)))


@pytest.mark.parametrize("chunk", [1500, 5])
def test_embedding_pairs(spark, chunk, monkeypatch):
    monkeypatch.setattr(E, "CHUNK", chunk)
    draw = np.random.default_rng(2)
    rows = []
    for label in (0, 1, 2):
        for c in range(12):
            centre = draw.standard_normal(20)
            for _ in range(int(draw.integers(1, 9))):
                rows.append((len(rows), label, (centre + draw.standard_normal(20) * 0.25 * (c % 3)).tolist()))
    rows += [(900, None, [1.0] * 20), (901, 0, None), (902, 0, [0.0] * 20), (903, 0, [float("nan")] + [1.0] * 19), (904, 0, [float("inf")] * 20),
             (905, 0, [1.0, None]), (906, 1, [1.0, 0.0]), (907, 1, [2.0, 0.0]), (908, 1, []), (909, 2, [1e-30, 0.0]), (910, 2, [1e30, 0.0])]
    got = E.near_vectors(spark.createDataFrame([(i, v, k, "x") for i, k, v in rows], "vec_id long, embedding array<double>, label int, size string"), 0.93)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == brute_vectors(rows, 0.93)
    assert got.where("kept != (vec_id = component_id)").count() == 0


def test_embedding_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert E.near_vectors(spark.createDataFrame([], schema)).count() == 0
    twice = spark.createDataFrame([(4, [1.0, 0.5], 1), (4, [1.0, 0.5], 1), (9, [2.0, 1.0], 1)], schema)
    assert sorted(map(tuple, E.near_vectors(twice).collect())) == [(4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)]


def test_embeddings_with_null_ids_and_labels_of_any_type(spark):
    for kind, same, other in (("string", "a", "b"), ("long", 1 << 40, 1)):
        rows = [(None, [1.0, 0.5], same), (7, [1.0, 0.5], same), (3, [1.0, 0.5], other), (None, [0.0, 1.0], same), (5, [1.0, 0.0], None)]
        got = E.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
        assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in got) == [
            (-1, 0, -1, False), (-1, 1, 7, False), (3, 0, 3, True), (5, 0, 5, True), (7, 1, 7, True)]


def test_sketches_lose_no_similar_pair(rng=np.random.default_rng(5)):
    rule, passed = N.Rule(), 0
    for n in (1, 2, 7, 255, 256, 257, 3_000):
        one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for drop in (0.0, 0.02, 0.05, 0.1, 0.2, 0.6):
            kept = one[rng.random(len(one)) >= drop]
            two = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(drop * n), dtype=np.uint64)]))
            if not len(two):
                continue
            similar = N._similar(one.tobytes(), two.tobytes(), rule)
            may = N._may_be_similar(N._sketch(one), N._sketch(two), rule)
            assert may or not similar
            passed += may and not similar
            assert not (may and drop >= 0.2 and n >= 255)
    assert passed < 6


def test_whole_sets_travel_for_likely_pairs_only(spark, monkeypatch):
    """Texts that share a tenth of their shingles meet in buckets and pass the short signatures, but not the sketches."""
    sent, decided = [], N._decided

    def watched(pairs, docs, sets, rule, sketched):
        if not sketched:
            sent.append(pairs.count())
        return decided(pairs, docs, sets, rule, sketched)

    monkeypatch.setattr(N, "_decided", watched)
    words = [f"w{k}" for k in range(6_000)]
    texts = [" ".join(words[:300] + [f"x{d}y{k}" for k in range(2_700)]) for d in range(6)] + [" ".join(words[3_000:])] * 2
    texts += [" ".join(words[3_000:] + ["tail"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.similar_documents(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 6}
    assert sum(sent) <= 2


def test_spanning_forest(rng=np.random.default_rng(3)):
    for n, many in ((1, 0), (30, 25), (200, 150), (60, 1500)):
        i, j = rng.integers(0, n, (2, many))
        labels = rng.integers(0, n, n)
        parts = [("part", int(x)) for x in labels]
        want = roots_of([(parts[a], parts[b]) for a, b in zip(i.tolist(), j.tolist())])
        now = labels.copy()
        some = N._spanning(i, j, now)
        assert roots_of([(parts[i[k]], parts[j[k]]) for k in some.tolist()]) == {x: r for x, r in want.items() if sum(y == r for y in want.values()) > 1}
        assert len(some) == len(want) - len(set(want.values()))  # no circle
        assert all(now[a] == now[b] for a, b in zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("rule", [N.Rule(), N.Rule(5, 4, 5)])
def test_pairs_of_a_large_group_of_near_copies_grow_with_its_sets(rule):
    """A bucket of copies at many distances from one text: thousands of candidate pairs, of which a forest is handed on."""
    import pyarrow as pa

    draw = random.Random(4)
    base, texts, copy = [f"w{k}" for k in range(150)], [], []
    for i in range(200):
        copy = list(copy if i % 4 else base)
        copy[draw.randrange(150)] = f"x{draw.randrange(400)}"
        texts.append(" ".join(copy))
    sets = {N.hashlib.blake2b(t.tobytes(), digest_size=16).digest(): t for t in (N.shingles(x, rule.words) for x in texts)}
    prints = sorted(sets)
    odd = lambda t: np.packbits((np.bincount((t >> np.uint64(40)).astype(np.int64) % N.BITS, minlength=N.BITS) & 1).astype(np.uint8)).tobytes()
    many, token = len(prints), np.repeat([5, 6], len(prints))
    zeros = pa.array(np.zeros(2 * many, np.int32))
    part = pa.RecordBatch.from_arrays([pa.array(token), zeros, zeros, zeros, pa.array([len(sets[x]) for x in prints] * 2), zeros,
                                       pa.array(prints * 2), pa.array(prints * 2), pa.array([odd(sets[x]) for x in prints] * 2)],
                                      names=["token", "left", "right", "part", "n", "pos", "print", "root", "bits"])
    all_, tree, first = (N._pairs_of(part, pick, rule).to_pylist() for pick in ("all", "tree", "first"))
    assert len(all_) > 10 * many
    pairs = lambda rows, k: [(r["a"], r["b"]) for r in rows if r["token"] == k]
    for k in (5, 6):
        want = roots_of(pairs(all_, k))
        assert roots_of(pairs(tree, k)) == want
        assert len(pairs(tree, k)) == len(want) - len(set(want.values()))
        best = {}
        for r in all_:
            best[r["b"]] = min(best.get(r["b"], r["far"]), r["far"])
        assert {r["b"]: r["far"] for r in first if r["token"] == k} == best


def sized(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(8)) for _ in range(n))


def test_only_shared_prefix_tokens_are_shuffled(spark):
    draw = random.Random(4)
    base = sized(draw, 300)
    rows = [(i, sized(draw, 300)) for i in range(300)] + [(1000, base), (1001, base + " more words at the end"), (1002, ""), (1003, None), (1004, "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = N.signatures(docs, N.common_tokens(docs, N.Rule()), N.Rule()).cache()
    marks = N.shared_marks(signed)
    assert np.bitwise_count(marks).sum() < 200
    kept = {r.doc_id: r for r in N.with_shared(signed, marks).collect()}
    assert set(kept) == {r[0] for r in rows} - {1002, 1003}
    prefixes = {r.doc_id: r.prefix for r in signed.collect()}
    both = set(prefixes[1000]) & set(prefixes[1001])
    assert both and all(both <= set(kept[k].token) for k in (1000, 1001))
    assert all([prefixes[k][p] for p in r.pos] == list(r.token) for k, r in kept.items())
    # A set that shares no token carries nothing but its size; a few are marked because 32 bits of two tokens are equal.
    assert sum(r.group is None and not r.token and r.bits is None for r in kept.values()) >= 295


@pytest.mark.parametrize("marks, parts, counted", [(1 << 11, 256, 500), (1 << 13, 4, 100)])
def test_a_full_bitmap_of_marks_loses_no_pair(spark, families, marks, parts, counted, monkeypatch):
    for name, value in (("MARKS", marks), ("PARTS", parts), ("COUNTED", counted)):
        monkeypatch.setattr(N, name, value)
    sets = shingle_sets(families, 3)
    ids = [i for i in sets if sets[i]]
    want = roots_of([(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])])
    got = N.similar_documents(spark.createDataFrame(families, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want.get(i, i)) for i in sets}
