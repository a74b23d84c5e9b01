"""Runs that stop after each of their results, take up again, and appear as a whole."""

from __future__ import annotations

from pathlib import Path

import pytest

from tests.conftest import values
from tests.test_jobs import close
from wattledger.plans import publishing
from wattledger.plans.full_run import OUTPUTS, Run, read_saved, run_all
from wattledger.plans.storage import is_written
from wattledger.sources.writers import write_parquet


class Stopped(Exception):
    pass


@pytest.fixture(scope="module")
def raw(grid, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    for table in publishing.RAW_TABLES:
        write_parquet(getattr(grid, table), str(base / f"{table}.parquet"))
    return base


@pytest.fixture(scope="module")
def whole(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("whole"))
    return out, run_all(spark, str(raw), out, raw_format="parquet", out_format="parquet")


def stop(name: str) -> None:
    raise Stopped(name)


def test_a_run_that_stops_after_each_result(spark, raw, whole, tmp_path):
    """Every start does one result more; what was finished is not written again, and nothing is visible before the end."""
    out = str(tmp_path)
    run = Run(spark, str(raw), out, "parquet", "parquet")
    written_at: dict = {}
    for count in range(1, len(OUTPUTS) + 1):
        with pytest.raises(Stopped):
            publishing.publish_run(run, "r1", stop)
        assert publishing.published_run(spark, out) is None
        names = [r["name"] for r in publishing.manifest(spark, out, "r1").collect()]
        assert len(names) == count
        for name in names:
            files = {f: f.stat().st_mtime_ns for f in (tmp_path / "runs/r1" / OUTPUTS[name].folder / name).iterdir()}
            assert written_at.setdefault(name, files) == files
    with pytest.raises(ValueError):
        publishing.read_published(spark, out, "grid_balance", whole[1]["grid_balance"].schema, "parquet")
    publishing.publish_run(run, "r1", stop)  # nothing is left to stop after
    assert publishing.published_run(spark, out) == "r1"
    assert not (tmp_path / "runs/r1/work").exists()
    rows = {r["name"]: r["rows"] for r in publishing.manifest(spark, out, "r1").collect()}
    for name in OUTPUTS:
        schema = whole[1][name].schema
        expected = read_saved(spark, whole[0], name, schema, "parquet")
        found = publishing.read_published(spark, out, name, schema, "parquet")
        assert close(values(found)) == close(values(expected)), name
        assert rows[name] == expected.count()


def test_a_table_half_written_is_written_again(spark, raw, whole, tmp_path):
    """Stopped in the middle of an intermediate table and of a result: no marker of success, some leftovers."""
    out = str(tmp_path)
    run = Run(spark, str(raw), out, "parquet", "parquet")
    with pytest.raises(Stopped):
        publishing.publish_run(run, "r", stop)
    for leftover in ("work/meter_totals", "demand/hourly_demand"):
        folder = tmp_path / "runs/r" / leftover
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "_SUCCESS").unlink(missing_ok=True)
        (folder / "part-00000-broken.parquet").write_bytes(b"half")
    publishing.publish_run(run, "r")
    schema = whole[1]["meter_zscores"].schema
    found = publishing.read_published(spark, out, "meter_zscores", schema, "parquet")
    assert close(values(found)) == close(values(read_saved(spark, whole[0], "meter_zscores", schema, "parquet")))
    assert not is_written(spark, f"{out}/runs/r/work/meter_totals")


def test_readers_stay_with_their_run(spark, raw, whole, tmp_path):
    out = str(tmp_path)
    run = Run(spark, str(raw), out, "parquet", "parquet")
    publishing.publish_run(run, "monday")
    schema = whole[1]["type_demand"].schema
    before = publishing.read_published(spark, out, "type_demand", schema, "parquet")
    with pytest.raises(Stopped):
        publishing.publish_run(run, "tuesday", stop)
    assert publishing.published_run(spark, out) == "monday"
    publishing.publish_run(run, "tuesday")
    assert publishing.published_run(spark, out) == "tuesday"
    assert "runs/monday" in before.inputFiles()[0] and before.count() == 3
    publishing.publish_run(run, "monday")  # complete: left as it is
    assert publishing.published_run(spark, out) == "tuesday"


def test_other_raw_files_are_refused(spark, raw, tmp_path):
    own = tmp_path / "raw"
    own.mkdir()
    for table in publishing.RAW_TABLES:
        write_parquet(spark.read.parquet(str(raw / f"{table}.parquet")).limit(50), str(own / f"{table}.parquet"))
    run = Run(spark, str(own), str(tmp_path / "out"), "parquet", "parquet")
    with pytest.raises(Stopped):
        publishing.publish_run(run, "r", stop)
    write_parquet(spark.read.parquet(str(raw / "weather.parquet")).limit(40), str(own / "weather.parquet"))
    with pytest.raises(ValueError, match="changed"):
        publishing.publish_run(run, "r")
    assert Path(own).exists()
