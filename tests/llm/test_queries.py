import os

import pytest

import corpus_pipeline
from oracle import DATA, compare, connect
from stratalake.llm import quality, simhash, toxicity, viterbi
from stratalake.llm.queries import registry

SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(registry.queries))
def test_query(spark, name):
    df = registry.queries[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    if name in registry.oracle:
        assert compare(df, connect(SF), registry.oracle[name]) == ""
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ["op5_budgeted_chat_windows", "op8_sampled_splitters", "op10_curriculum_mix"])
def test_native_plans_have_no_python(spark, name):
    plan = registry.queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality classifier"](spark, docs, SF)
    want = {r.doc_id for r in quality.score(docs, labels).collect() if r.predicted == 1}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == want
    clean = steps["toxicity"](spark, good, SF)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in toxicity.score(good, labels).collect() if r.predicted == 0}
    single = steps["simhash near-dedup"](spark, clean, SF)
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in simhash.near_duplicates(clean).collect()}
    assert single.columns == columns
    mixed = steps["mixing to target weights"](spark, single, SF)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in single.collect()}
    coded = steps["sentencepiece encoding"](spark, mixed, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    spelled = viterbi.Pieces.load().spelled
    assert len(coded) == mixed.count() and all(viterbi.decode_ids(r.ids, spelled) == texts[r.doc_id] for r in coded)


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
