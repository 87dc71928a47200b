"""The registered queries: against their SQL where there is one, else by their contracts."""

import pytest

import check
import corpus_pipeline
from vitalgrid.llm import workload
from vitalgrid.llm.common import table

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(workload.all_sql()))
def test_query_equals_its_sql(spark, name):
    ok, message = check.compare(spark, check.duck(FOLDER), FOLDER, name, workload.all_queries()[name], workload.all_sql()[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(workload.all_queries()) - set(workload.all_sql()) - {"op11_whitening"}))
def test_query_gives_a_row_a_document(spark, name):
    got = workload.all_queries()[name](spark, FOLDER)
    docs = table(spark, FOLDER, "documents")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_whitening_gives_eight_rows_a_vector(spark):
    got = workload.all_queries()["op11_whitening"](spark, FOLDER).collect()
    assert len(got) == 8 * table(spark, FOLDER, "embeddings").count() and got[0].identity_error < 1e-9


def test_no_python_in_native_queries(spark):
    for name in ("op2_mix_sources", "op9_quality_rules", "op10_license_scan"):
        plan = workload.all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        rows = out.collect()
        if name.startswith(("quality", "exact", "SimHash")):
            before = {r.doc_id for r in docs.collect()}
            assert {r.doc_id for r in rows} <= before and len(rows) == len({r.doc_id for r in rows}), name
        if name.startswith("exact"):
            assert len({r.text for r in rows}) == len(rows) == docs.select("text").distinct().count()
        docs = spark.createDataFrame(rows, out.schema)
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()
