"""The pipeline's stages, each on what the one before kept."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from strataflow.llm import quality_lists
from strataflow.llm.common import stored
from tools.check_oracle import compare, connect


def test_registered():
    names = set(entry.queries())
    assert {"pipeline"} <= names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert len(C.STAGES) == 5


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    source = {r.doc_id: r for r in docs.collect()}
    kept = [stored(docs, "start")]
    for name, stage in C.STAGES:
        kept.append(stored(stage(spark, kept[-1], small), name))
    first, clean, single, mixed, coded = kept[1:]
    assert all(k.columns == columns for k in (first, clean, single, mixed))
    good = quality_lists.judge(docs, spark.read.parquet(f"{small}/labels.parquet")).where("kept")
    assert sorted(r.doc_id for r in first.collect()) == sorted(r.doc_id for r in good.collect())
    assert clean.count() == first.count()
    for r in clean.collect():
        lines, own = r.text.split("\n") if r.text else [], source[r.doc_id].text.split("\n")
        rest = iter(own)
        assert all(any(x == y for y in rest) for x in lines) and r.n_chars == len(r.text)
    ids = [r.doc_id for r in single.collect()]
    assert len(ids) == len(set(ids)) <= clean.count()
    sets = {r.doc_id: shingles(r.text) for r in clean.collect()}
    singles = [sets[i] for i in ids if sets[i]]
    for i, s in sets.items():
        if i not in set(ids):
            assert any(5 * len(s & t) >= 4 * len(s | t) for t in sets.values() if t is not s)
    assert all(5 * len(s & t) < 4 * len(s | t) for k, s in enumerate(singles) for t in singles[:k])
    drawn = [r.doc_id for r in mixed.collect()]
    assert set(drawn) == set(ids) and max(drawn.count(i) for i in set(drawn)) <= 2
    assert sorted(r.doc_id for r in coded.collect()) == sorted(drawn) and coded.where("not intact").count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("name", ["op1_site_lines", "op2_source_mix", "op4_embedding_pairs", "op8_ngram_groups", "op13_collocations"])
def test_sql(spark, small, name):
    assert compare(spark, connect(small), name, small)
