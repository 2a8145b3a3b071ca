import pytest

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.cases import awkward_docs, no_docs
from tests.llm.test_dedup_and_rules import measures
from tests.llm.test_ngram_join import brute
from tests.oracle import compare, connect
from tillwork.llm import queries

NATIVE = ("op1_exact_dedup", "op3_mixing", "op5_secret_scan", "op6_quality_rules")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries(name, spark, duck):
    frame = queries.QUERIES[name](spark, DATA)
    if name in queries.ORACLES:
        assert compare(frame, duck, queries.ORACLES[name]) is None
    else:
        assert frame.count() > 0


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(name, spark):
    frame = queries.QUERIES[name](spark, DATA)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_every_stage_takes_awkward_and_empty_tables(spark):
    for docs in (awkward_docs(spark), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, DATA).columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() >= 0


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, DATA)
    failed = {r.doc_id for r in docs.collect() if measures(r.text)[-1]}
    assert not failed & {r.doc_id for r in good.collect()}
    once = stages["exact dedup"](spark, good, DATA).collect()
    assert len({r.text for r in once}) == len(once) == good.select("text").distinct().count()
    frame = spark.createDataFrame(once, docs.schema)
    near = {r.doc_id for r in stages["near duplicates"](spark, frame, DATA).collect()}
    assert near == {i for i, _, c in brute([(r.doc_id, r.text) for r in once], 5, 80) if i == c}


def test_the_whole_pipeline_packs_what_the_mix_takes(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.count() > 0 and "sequence_id" in rows.columns
