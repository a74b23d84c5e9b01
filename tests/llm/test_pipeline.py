"""The corpus pipeline: contracts of its stages, and the registered queries over the smallest test data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.compare import duckdb_result, spark_result
from tests.llm.conftest import DOCUMENTS
from tests.llm.test_dedup import plain_cut
from tests.llm.test_near_copies import plain_groups
from tests.llm.test_tokens import check_packing
from wattledger.llm import quality, toxicity
from wattledger.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def test_all_are_registered():
    names = {q.split("_")[0] for q in QUERIES}
    assert names <= {f"op{n}" for n in range(1, 14)} and names >= {f"op{n}" for n in range(1, 11)}
    assert QUERIES.keys() | {"pipeline"} <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_run(spark, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    assert rows and set(rows[0].asDict()) == set(df.columns)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    types, rows = spark_result(QUERIES[name](spark, SMALL))
    expected_types, expected = duckdb_result(con, ORACLES[name])
    assert types == expected_types
    assert rows == expected


def test_every_stage_does_its_work(spark):
    """Each stage against the plain version of its decision on the stage's own input."""
    docs = table(spark, "documents")
    labels = table(spark, "labels")
    columns = docs.columns
    result = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in result.collect()]
        given = spark.createDataFrame(before, result.schema)
        after = stage(spark, given, SMALL)
        rows = [tuple(r) for r in after.collect()]
        if number < 4:
            assert after.columns == columns
        if number == 0:
            toxic = {r["doc_id"] for r in toxicity.toxicity_scores(given, labels).where("predicted = 1").collect()}
            assert sorted(rows) == sorted(r for r in before if r[0] not in toxic)
        elif number == 1:
            kept = {r["doc_id"] for r in quality.quality_rules(given, labels).where("kept").collect()}
            assert sorted(rows) == sorted(r for r in before if r[0] in kept) and len(rows) < len(before)
        elif number == 2:
            first = {i for i, low in plain_groups(before) if i == low}
            assert sorted(rows) == sorted(r for r in before if r[0] in first) and len(rows) < len(before)
        elif number == 3:
            cut = {i: (gone, text) for i, _, gone, text in plain_cut(before, 50)}
            assert sorted(r[:2] for r in rows) == sorted((r[0], cut[r[0]][1] if cut[r[0]][0] else r[1]) for r in before)
        else:
            check_packing(after.collect(), [r[:2] for r in before], 1024, 2)
        result = spark.createDataFrame(rows, after.schema)


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SMALL)
    docs = table(spark, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(tuple(r) for r in got.select(key).collect()) == sorted(tuple(r) for r in docs.select(key).collect())


@pytest.mark.parametrize("number", range(5))
def test_stages_take_awkward_and_empty_tables(spark, awkward, empty, number):
    _, stage = corpus_pipeline.STAGES[number]
    result = stage(spark, awkward, SMALL)
    assert stage(spark, empty, SMALL).collect() == []
    rows = result.collect()
    if number < 4:
        assert result.columns == awkward.columns
        assert len(rows) <= awkward.count()
    if number in (2, 3, 4):
        assert rows


def test_nothing_else_needs_the_subpackage():
    """The library and the entry script import the subpackage nowhere but in the guarded place."""
    import re
    from pathlib import Path

    root = Path(entry_point.__file__).parent
    for path in [*root.glob("wattledger/**/*.py"), *root.glob("verification/*.py"), root / "bench.py", root / "analyze_grid.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"wattledger[. ]+(import )?llm|corpus_pipeline", path.read_text()), path


def test_documents_schema_matches_the_data(spark):
    assert [f.split()[0] for f in DOCUMENTS.split(", ")] == table(spark, "documents").columns
