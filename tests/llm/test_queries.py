"""Registered corpus queries against their DuckDB SQL, and the pipeline."""

import duckdb
import pytest

from fieldlake.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_as_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    want = con.sql(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    order = lambda df: df[cols].sort_values(cols).reset_index(drop=True)
    assert order(got).equals(order(want.astype(got[want.columns].dtypes.to_dict())))


def test_names():
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))


def test_long_repeat_query_has_its_columns(spark, sf):
    assert registry.queries()["op8_run_index"](spark, sf).columns == [
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] and sizes[5] == sizes[4]
    assert docs.where("size(token_ids) = 0 and length(text) > 0").isEmpty()


def test_pipeline_of_odd_rows(spark, odd, sf, tmp_path):
    import corpus_pipeline

    for rows, name in ((odd, "odd"), (odd.limit(0), "none")):
        docs = rows
        for k, (step, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{name}{k}")
            stage(spark, docs, sf).write.parquet(path)
            docs = spark.read.parquet(path)
            if step != "encode":
                assert docs.columns == odd.columns
        assert (docs.count() > 0) == (name == "odd")
