"""Each job by itself, with only the tables that it needs, against the run of all jobs."""

from __future__ import annotations

import pytest

from tests.conftest import values
from wattledger.plans.full_run import JOBS, OUTPUTS, Run, read_saved, run_all
from wattledger.sources.writers import write_parquet

NEEDS = {
    "demand": ["meter_readings"],
    "supply": ["plant_output", "weather"],
    "fraud": ["meter_readings"],
    "balance": [],
    "carbon": ["plant_output"],
}


@pytest.fixture(scope="module")
def raw(grid, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    for table in ("meter_readings", "plant_output", "weather"):
        write_parquet(getattr(grid, table), str(base / f"{table}.parquet"))
    return base


@pytest.fixture(scope="module")
def whole(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("whole"))
    return out, run_all(spark, str(raw), out, raw_format="parquet", out_format="parquet")


def close(rows):
    return [tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in row) for row in rows]


def test_jobs_one_by_one(spark, raw, whole, tmp_path):
    out = str(tmp_path / "out")
    for job, tables in NEEDS.items():
        own = tmp_path / job
        own.mkdir()
        for table in tables:
            (own / f"{table}.parquet").symlink_to(raw / f"{table}.parquet")
        JOBS[job](Run(spark, str(own), out, "parquet", "parquet"))
    for name in OUTPUTS:
        schema = whole[1][name].schema
        mine, all_ = (read_saved(spark, folder, name, schema, "parquet") for folder in (out, whole[0]))
        assert close(values(mine)) == close(values(all_)), name


def test_scratch_tables_of_a_job_are_gone_after_it(spark, raw, tmp_path):
    from pathlib import Path

    from wattledger.plans.storage import CHECKPOINT_DIR

    root = Path(spark.conf.get(CHECKPOINT_DIR).removeprefix("file:"))
    before = set(root.iterdir()) if root.exists() else set()
    JOBS["demand"](Run(spark, str(raw), str(tmp_path / "out"), "parquet"))
    assert set(root.iterdir()) == before


def test_a_full_run_refuses_a_used_folder(spark, raw, tmp_path):
    folder = str(tmp_path / "mine")
    spark.range(1).write.parquet(f"{folder}/readings")
    with pytest.raises(Exception, match="(?i)exists"):
        run_all(spark, str(raw), str(tmp_path / "out"), raw_format="parquet", folder=folder)
    assert spark.read.parquet(f"{folder}/readings").count() == 1
