"""Quality lists, site lines and source mixing against brute force."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import quality_lists as Q
from strataflow.llm import site_lines as L
from strataflow.llm import source_mix as M


def counts(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_statistics(odd_docs, clashing, spark):
    extra = spark.createDataFrame([(20, "a b c d e f g h a b c d e f g h\nx\nx\n \n", None, None, 1), (21, "a " * 40, None, None, 1),
                                   (22, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 0 2 3 4 5 6 7 8 9", None, None, 1)], odd_docs.schema)
    for docs in (odd_docs.union(extra), clashing):
        got = Q.with_statistics(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            s = r.stats
            assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == counts(r.text), r.doc_id
    assert set(Q.with_statistics(clashing).columns) == set(clashing.columns)


def test_learned_rules_separate(spark):
    good = "plain words of an ordinary text that goes on for a while and says this and that about nothing in particular number"
    rows = [(i, f"{good} {i}") for i in range(300)] + [(1000 + i, " ".join(f"{w.upper()}!!" for w in f"{good} {i}".split())) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows if i % 2] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = Q.judge(docs, labels)
    assert {r.doc_id for r in out.where("kept").collect()} == {i for i, _ in rows if i < 1000}
    rules = Q.learn(Q.with_statistics(docs).select("doc_id", "stats"), labels)
    assert rules and all(1 <= len(r) <= 3 for r in rules)


def test_quality_edges(odd_docs, clashing, no_docs, spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1)], "doc_id long, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.judge(odd_docs, labels).collect()
    assert len(got) == 12 and all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert Q.judge(no_docs, none).count() == 0
    assert Q.judge(odd_docs, none).where("kept = base_failed").count() == 0
    kept = Q.keep_good(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() > 0


def test_site_lines(spark):
    rows = [(i, "s", f"HEADER\nbody {i}\n\nfoot {i // 10}") for i in range(20)] + [(100, "t", "HEADER\nx"), (101, None, "HEADER\ny"), (102, "s", None)]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in L.clean_documents(docs, share=0.4, least_pages=3).collect()}
    # HEADER is on 20 of 21 pages of s; each footer on 10 of 21.
    assert got[3].text == "body 3\n" and got[3].n_chars == 7
    assert (got[100].text, got[101].text, got[102].text) == ("HEADER\nx", "HEADER\ny", None)


def test_repeated_passages_of_a_large_source(spark):
    from corpus_pipeline import drop_boilerplate
    passage = "This long passage was planted in a few dozen of the many documents that the source holds."
    block = ["A second passage of two lines stands in thirty documents, here is its first line.", "And this is the second line of it, which follows."]
    own = lambda i: [f"{i}{k} own words of document {i} which no other document has in line {k}" for k in range(3)]
    texts = {i: own(i) for i in range(600)}
    for i in range(24):
        texts[i] = [own(i)[0], passage, *own(i)[1:]]
    for i in range(100, 130):
        texts[i] = [*block, *own(i), "short"]
    copied = [f"Line {k} of a long text that has been copied as a whole into many documents." for k in range(12)]
    texts |= {i: copied for i in range(1000, 1040)} | {i: [*copied[:11], f"{i}"] for i in range(1040, 1060)}
    rows = [(i, "\n".join(t), "en", "big", 1) for i, t in texts.items()]
    got = {r.doc_id: r.text.split("\n") for r in drop_boilerplate(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "").collect()}
    assert got.keys() == texts.keys()
    for line in (passage, *block):
        assert sum(line in t for t in got.values()) == 1
    assert all(set(texts[i]) - {passage, *block} <= set(got[i]) for i in texts)  # all else stays, short lines, too
    assert all(got[i] == texts[i] for i in range(1000, 1060))  # copies are not emptied


def test_site_lines_edges(odd_docs, clashing, no_docs):
    assert L.clean_documents(no_docs).count() == 0
    out = L.clean_documents(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    assert out.where("doc_id = 1").first().text is None


def test_html_and_hosts(spark):
    row = spark.createDataFrame([("<p>a <b>c</b> d</p><div> e\nf</div>", "HTTPS://me@A.Example.com:80/x"), (None, "no url")], "h string, u string")
    got = row.select(L.html_lines(F.col("h")).alias("l"), L.url_host(F.col("u")).alias("h")).collect()
    assert got[0].l == ["a c d", "e", "f"] and got[0].h == "a.example.com" and got[1].l == [] and got[1].h is None


@pytest.mark.parametrize("limit", [{"most_passes": 2.0}, {"most_passes": 1.0}, {"least_entropy": 0.97}])
def test_exponent(limit):
    tokens = [10_000, 900, 1_000, 0, 40]
    e = M.find_exponent(tokens, **limit)
    w = M.weights(tokens, e)
    assert math.isclose(sum(w), 1)
    if "most_passes" in limit:
        assert max(M.repetitions(tokens, e)) <= limit["most_passes"] + 1e-9
        assert limit["most_passes"] == 1 or max(M.repetitions(tokens, max(0, e - 1e-6))) > limit["most_passes"]
    else:
        assert abs(M.entropy(w) - 0.97 * math.log(4)) < 1e-6


def test_mix_budgets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "big" if i < 800 else "small") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(docs, most_passes=2.5).collect()
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
    drawn, seen = Counter(), Counter()
    for r in got:
        drawn[r.source] += len(r.text.split())
        seen[r.doc_id] += 1
    assert set(seen) == {i for i, _, _ in rows} and max(seen.values()) - min(v for k, v in seen.items() if k >= 800) <= 1
    assert drawn["big"] == tokens["big"] and 0 <= drawn["small"] - 2.5 * tokens["small"] < 8
    # An epoch takes whole blocks in the order of its permutation, and part of one block at the end.
    last = [r for r in got if r.source == "small" and r.epoch == 3]
    blocks = {r.block_rank for r in last}
    assert max(blocks) < M.BLOCKS and all(r.block_rank <= max(blocks) for r in last)


def test_mix_edges(odd_docs, clashing, no_docs):
    assert M.mix_documents(no_docs).count() == 0
    out = M.mix(clashing)
    assert out.count() >= clashing.count() and out.columns == [c for c in clashing.columns if c not in ("epoch", "weight")] + ["epoch", "block_rank", "weight"]
    assert M.mix_documents(odd_docs).columns == odd_docs.columns


def test_only_texts_that_lose_lines_are_shuffled(spark):
    """Also when the lists of lost lines are too large to be handed to all tasks."""
    passage = "A long passage that stands in forty of the eight hundred documents of its source."
    rows = [(i, "\n".join([f"{i} has words of its own", *([passage] if i % 20 == 0 else []), f"{i} ends"]), "en", "big", 1) for i in range(800)]
    docs = spark.createDataFrame([*rows, (800, passage, "en", None, 1), (801, None, "en", "big", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.clean_documents(docs, share=0.2, least_pages=5, long_line=40, least_texts=10)
        got = {r.doc_id: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 802 and got[800].text == passage and got[801].text is None
    assert sum(passage in (r.text or "") for r in got.values()) == 2
    assert all(got[i].text == f"{i} has words of its own\n{i} ends" and got[i].n_chars == len(got[i].text) for i in range(800) if passage not in got[i].text)

    def shuffled(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return shuffled(node.executedPlan())
        if "QueryStage" in name:
            return shuffled(node.plan())
        own = 0
        if name == "Exchange" and "text#" in node.output().toString():
            own = node.metrics().apply("shuffleRecordsWritten").value()
        return own + sum(shuffled(node.children().apply(k)) for k in range(node.children().size()))

    assert 39 <= shuffled(out._jdf.queryExecution().executedPlan()) <= 45
