"""Target resampling, additive quality scores and collocations against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import additive_quality as A
from strataflow.llm import collocations as P
from strataflow.llm import target_sample as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def runs(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return w, [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resampled(docs, target, rule):
    """Rows of docs [(doc_id, text)] as the definition has them, one n-gram after the other."""
    bucket = lambda f: zlib.crc32(f.encode()) % rule.buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, runs(text)[1]))
    for text in target:
        t.update(map(bucket, runs(text)[1]))
    all_s, all_t, size = s.total(), t.total(), rule.buckets
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * (all_s + size)) / ((s[b] + 1) * (all_t + size)))) for b in s}
    rows, fit = [], []
    for doc_id, text in docs:
        w, f = runs(text)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(w) >= rule.least_words:
            fit.append(rows[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, row in enumerate(fit[:rule.percent * len(fit) // 100]):
        row[4] = k + 1
    return sorted(map(tuple, rows), key=repr)


def same_sample(docs, target, rule=T.Rule()):
    out = T.resample(docs, target, rule)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
    want = resampled([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [r.text for r in target.select("text").collect()], rule)
    assert sorted(map(tuple, out.collect()), key=repr) == want
    return want


def test_resample_on_tables(spark, small):
    want = same_sample(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet"))
    assert sum(r[4] is not None for r in want) == 5 * sum(r[1] >= 57 for r in want) // 100


def test_resample_edges(spark, odd_docs, no_docs, clashing):
    rule = T.Rule(buckets=50, percent=60, least_words=2)
    goals = spark.createDataFrame([(1, "the quick fox\nof fox\n\nand\nthe"), (2, None), (3, "")], "item_id long, text string")
    none = spark.createDataFrame([], goals.schema)
    for docs in (odd_docs, clashing):
        same_sample(docs, goals, rule)
    same_sample(odd_docs, none, rule)
    assert T.resample(no_docs, goals, rule).count() == 0
    unique = odd_docs.where("doc_id IN (4, 6, 8, 9)").withColumn("rank", F.lit("x"))
    drawn = T.drawn_texts(unique, goals, rule)
    assert drawn.columns == unique.columns and drawn.count() == 1


def test_crossing_runs(monkeypatch, spark):
    """Lines of one word, empty lines, and segments longer than their names; counters that are emptied often."""
    monkeypatch.setattr(T, "FLUSH", 7)
    monkeypatch.setattr(T, "WORDS_AT_ONCE", 20)
    r = random.Random(5)
    texts = ["".join(r.choice(["a", "B", "c9", "é", "dd"]) + r.choice([" ", "\n", "\n\n", " - ", "\r\n"]) for _ in range(n)) for n in range(60)]
    texts += ["one\ntwo\nthree\nfour", "a" * 90 + "\n" + "b " * 60] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    same_sample(docs, docs.where("doc_id % 7 = 0"), T.Rule(buckets=300, percent=50))


def test_global_rank(spark):
    rows = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(70))).alias("score"), "id")
    got = T.ranked(rows, [F.desc("score"), F.asc("id")]).collect()
    want = sorted(got, key=lambda r: (-r.score, r.id))
    assert [r.rank for r in want] == list(range(1, 5001))


def phrases(rows, rule):
    """Result rows of [(text, lang)] by the definition."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, rule.longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        known = {p: a for p, a in counts.items() if len(p) > 1 and a >= rule.least}
        inside = {}
        for p, a in known.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(a, inside.get(p[i:i + size], 0))
        kept = []
        for p, a in known.items():
            if inside.get(p, -1) < a:
                score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(kept)[:rule.first]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def same_phrases(docs, rule):
    got = P.collocations(docs, rule)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = phrases([(r.text, r.lang) for r in docs.select("text", "lang").collect()], rule)
    assert sorted(map(tuple, got.collect())) == want
    return want


def made_texts(seed):
    r = random.Random(seed)
    words = ["Aa", "bb", "CC", "dd", "é", "x\x85y", "…", "ee", "\x1cff"]
    return ["".join(r.choice(words[:3 + k % 7]) + r.choice([" ", " ", "\t", "  ", ", ", ".", "\n"]) for _ in range(r.randrange(60))) for k in range(60)]


@pytest.mark.parametrize("bits", [64, 3])
def test_collocations(spark, monkeypatch, bits):
    """With fingerprints of 3 bits nearly all collide and are counted again by their text."""
    monkeypatch.setattr(P, "WORDS_AT_ONCE", 150)
    rows = [(t, ("en", "de", None)[k % 3]) for k, t in enumerate(made_texts(3))] + [(None, "en"), ("", None), ("!!! , \n", "en")]
    docs = spark.createDataFrame(rows * 2, "text string, lang string")
    assert len(same_phrases(docs, P.Rule(least=6, first=25, bits=bits))) > 40


def test_collocation_edges(spark, odd_docs, no_docs, clashing):
    for docs in (odd_docs, clashing):
        same_phrases(docs, P.Rule(least=2))
    assert P.collocations(no_docs).count() == 0
    # A phrase of its own longer phrase's frequency is gone; one with an occurrence more stays.
    docs = spark.createDataFrame([("a b c. a b c. b c. d e", "en"), ("d e", "en")], "text string, lang string")
    assert {r[2] for r in same_phrases(docs, P.Rule(least=2))} == {"a b c", "b c", "d e"}


def test_scores_are_exact(spark):
    big = 3_037_000_499_123_457
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 2), ("en", "a b", 2, big - 5)], "lang string, phrase string, words int, count long")
    totals = spark.createDataFrame([("en", 9 * big + 1)], "lang string, n long")
    assert P.score_phrases(counts, totals).first().score == 1000 * (big - 5) * (9 * big + 1) // (big * (big + 2))


def test_bitmap(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("number"))
    bits = P.bitmap(rows)
    inside = np.array([r.number for r in rows.collect()], np.int64).view(np.uint64)
    assert P._bit_of(bits, inside).all()
    others = np.random.default_rng(1).integers(0, 2 ** 63, 10_000).astype(np.uint64)
    assert P._bit_of(bits, others).mean() < 0.06


def plain_scores(model, values):
    """Sums over tables, one value at a time."""
    place = lambda edge, v: sum(x < v for x in edge)
    out = []
    for row in values:
        x = model.intercept + sum(t[place(e, v)] for t, e, v in zip(model.tables, model.borders, row))
        x += sum(t[place(model.coarse[i], row[i])][place(model.coarse[j], row[j])] for (i, j), t in zip(model.pairs, model.pair_tables))
        out.append(1 / (1 + math.exp(-x)))
    return out


def test_quality_scores(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    how = A.Learning(models=2)
    rows = A.with_features(docs.select("doc_id", "text"))
    model = A.learn(rows, labels, "quality", how)
    got = {r.doc_id: r for r in A.score_quality(docs, labels, how=how).collect()}
    values = {r.doc_id: r["values"] for r in rows.collect()}
    assert len(got) == docs.count() == len(values)
    want = plain_scores(model, list(values.values()))
    for doc_id, score in zip(values, want):
        r = got[doc_id]
        assert abs(r.score - score) < 1e-9 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


def test_interactions_are_learned(spark):
    """Bad only where exactly one of two features is high: no sum of single tables can tell."""
    r = np.random.default_rng(2)
    values = r.random((3000, len(A.FEATURES)))
    y = ((values[:, 3] > 0.5) == (values[:, 9] > 0.5)).astype(float)
    edges = lambda n: [np.linspace(0, 1, n + 1)[1:-1]] * values.shape[1]
    how = A.Learning(rounds=60)
    held = np.arange(3000) % 5 == 0
    intercept, mains, pairs = A.fit_tables(A.binned(values, edges(32)), A.binned(values, edges(8)), y, held, how)
    assert (3, 9) in pairs
    model = A.Model(edges(32), edges(8), intercept, mains, sorted(pairs), np.array([pairs[p] for p in sorted(pairs)]))
    fresh = r.random((1000, len(A.FEATURES)))
    truth = (fresh[:, 3] > 0.5) == (fresh[:, 9] > 0.5)
    assert ((model.scores(fresh) > 0.5) == truth).mean() > 0.95


def test_best_tree_over_two_axes():
    """Against all cuts, tried one by one."""
    r = np.random.default_rng(4)
    for _ in range(20):
        g, h, n = r.normal(size=(5, 4)), r.random((5, 4)), np.full((5, 4), 3.0)
        part = lambda m: m[0] ** 2 / (m[1] + 1) if m[2] >= 5 else -math.inf
        best = -math.inf
        for a, b, c in ((g, h, n), (g.T, h.T, n.T)):
            for cut in range(1, a.shape[0]):
                total = 0
                for side in (slice(0, cut), slice(cut, None)):
                    cuts = [part((a[side, :k].sum(), b[side, :k].sum(), c[side, :k].sum())) + part((a[side, k:].sum(), b[side, k:].sum(), c[side, k:].sum()))
                            for k in range(1, a.shape[1])]
                    total += max(part((a[side].sum(), b[side].sum(), c[side].sum())), *cuts)
                best = max(best, total)
        assert A.tree_2d(g, h, n, 5)[1] == pytest.approx(best - g.sum() ** 2 / (h.sum() + 1))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = A.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95


def test_quality_edges(spark, odd_docs, no_docs, clashing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, 1), (8, 0), (9, None), (None, 1), (10, 1), (10, 0)], "doc_id long, quality int")
    one_kind, none = labels.where("doc_id = 4"), labels.limit(0)
    for docs in (odd_docs, clashing):
        got = A.score_quality(docs, labels).collect()
        assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in A.score_quality(odd_docs, one_kind).collect()} == {1.0}
    assert {r.score for r in A.score_quality(odd_docs, none).collect()} == {0.5}
    assert A.score_quality(no_docs, labels).count() == 0
