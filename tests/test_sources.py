from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wattledger.plans import storage
from wattledger.plans.sizing import broadcast_within
from wattledger.schemas import TABLES
from wattledger.sources import readers, writers

HEADER = "timestamp,meter_id,district_id,meter_type,kwh,voltage,power_factor"


def csv_file(tmp_path, *lines):
    path = tmp_path / "meter_readings.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_declared_schemas(spark, tmp_path):
    path = csv_file(tmp_path, HEADER, "2024-03-10 02:30:00,M1,D1,residential,1.5,240.1,0.9")
    readings = readers.read_meter_readings(spark, path)
    assert dict(readings.dtypes)["timestamp"] == "timestamp_ntz"
    assert all(field.nullable for field in readings.schema)
    assert readings.select(F.hour("timestamp")).first()[0] == 2
    assert len(TABLES) == 6


def test_hour_does_not_depend_on_the_session_time_zone(spark, tmp_path):
    path = csv_file(tmp_path, HEADER, "2024-03-10 02:30:00,M1,D1,residential,1.5,240.1,0.9")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert readers.read_meter_readings(spark, path).select(F.hour("timestamp")).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


DAMAGED = ["yesterday,M1,D1,residential,much,240.1,", ",,,,,,", "2024-06-01 00:00:00,M1", "2024-06-01 00:00:00,M1,D1,r,1,1,1"]


def test_damaged_rows_fail_by_default(spark, tmp_path):
    path = csv_file(tmp_path, HEADER, DAMAGED[0])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_meter_readings(spark, path).collect()
    assert values(readers.read_meter_readings(spark, csv_file(tmp_path, HEADER, DAMAGED[1])), "kwh") == [(None,)]


def test_damaged_rows_are_kept_and_counted_on_demand(spark, tmp_path):
    path = csv_file(tmp_path, HEADER, *DAMAGED)
    readings = readers.read_table(spark, "meter_readings", path, on_bad_rows="keep")
    assert values(readings, readers.CORRUPT) == sorted([(DAMAGED[0],), (DAMAGED[2],), (None,), (None,)], key=repr)
    assert values(readings.where("kwh IS NOT NULL"), "kwh") == [(1.0,)]
    assert values(readers.malformed_row_counts({"readings": readings})) == [("readings", 4, 2)]
    with pytest.raises(ValueError, match="bad rows"):
        readers.read_csv(spark, path, TABLES["meter_readings"], "guess")


def test_csv_loses_nothing(spark, frame, tmp_path):
    rows = [
        ("2024-06-01 00:00:00.75", 'a "quoted", text'),
        ("2024-06-01 00:00:00", ""),
        ("2024-06-01 00:00:00.000001", None),
        (None, "back\\slash, 'single'"),
        ("1999-12-31 23:59:59", " spaces "),
    ]
    df = frame(rows, "timestamp STRING, address STRING")
    path = str(tmp_path / "out")
    writers.write_csv(df, path)
    assert values(readers.read_csv(spark, path, df.schema)) == values(df)


@pytest.mark.parametrize("text", ["two\nlines", "two\r\nlines"])
def test_line_breaks_are_refused(frame, tmp_path, text):
    with pytest.raises(Exception, match="line break in CSV column address"):
        writers.write_csv(frame([(text,)], "address STRING"), str(tmp_path / "out"))


def test_header_must_match_the_schema(spark, tmp_path):
    path = csv_file(tmp_path, "meter_id,timestamp,district_id,meter_type,kwh,voltage,power_factor", "M1,x,D1,r,1,1,1")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_meter_readings(spark, path).collect()


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, "weather", "nowhere", "json")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_written_tables_read_back(spark, grid, tmp_path, fmt):
    path = str(tmp_path / "districts")
    write = writers.write_csv if fmt == "csv" else writers.write_parquet
    write(grid.districts, path)
    write(grid.districts, path)
    assert values(readers.read_table(spark, "districts", path, fmt)) == values(grid.districts)


def test_single_file_keeps_the_order(spark, tmp_path):
    path = str(tmp_path / "sorted")
    writers.write_csv(spark.range(1000).repartition(8).orderBy(F.desc("id")), path, single_file=True)
    (part,) = Path(path).glob("part-*.csv")
    assert part.read_text().split() == ["id", *[str(i) for i in range(999, -1, -1)]]


def test_row_counts(spark):
    counts = readers.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert values(counts) == [("a", 3), ("b", 0)]


def test_broadcast_guard(spark):
    small, large = spark.range(10), spark.range(11)
    hint = "ResolvedHint (strategy=broadcast)"
    analyzed = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert hint in analyzed(broadcast_within(small, 10))
    assert hint not in analyzed(broadcast_within(large, 10))


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get(storage.CHECKPOINT_DIR)
    first, second = storage.scratch_dir(spark), storage.scratch_dir(spark)
    assert first.startswith(root) and first != second

    class Context:
        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        conf = {}
        sparkContext = Context

    with pytest.raises(ValueError, match=storage.CHECKPOINT_DIR):
        storage.scratch_dir(Session())


def test_scratch_folders_are_deleted_and_never_overwritten(spark):
    with storage.scratch(spark) as folder:
        storage.written(spark.range(3), f"{folder}/table")
        local = Path(folder.removeprefix("file:"))
        assert local.is_dir()
        with pytest.raises(Exception, match="(?i)exists"):
            storage.written(spark.range(3), f"{folder}/table")
    assert not local.exists()


def test_concurrent_actions_keep_the_job_group(spark):
    spark.sparkContext.setLocalProperty("spark.job.description", "mine")
    try:
        found = storage.concurrently(spark, [lambda: spark.sparkContext.getLocalProperty("spark.job.description")] * 3)
    finally:
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert found == ["mine"] * 3


def test_whole_and_damaged_rows_add_up_to_the_lines(spark, tmp_path):
    """Two files with damaged rows in the middle and at both ends, an empty one and one with only a header."""
    from wattledger.sources.readers import split_rows

    header = "timestamp,meter_id,district_id,meter_type,kwh,voltage,power_factor"
    good = [f"2024-06-01 0{i}:00:00,m{i},d1,residential,{i}.5,240.0,0.9" for i in range(9)]
    bad = ["2024-06-01 00:00:00,m,d1,residential,much,240.0,0.9", "not a time,m,d,r,1.0,1.0,1.0", "2024-06-01 00:00:00,m1", ",,,,,,,,,"]
    files = {"a.csv": [bad[0], *good[:4], bad[1], *good[4:], bad[2]], "b.csv": [*good, bad[3]], "c.csv": [], "d.csv": good[:1]}
    raw = tmp_path / "raw.csv"
    raw.mkdir()
    for name, lines in files.items():
        (raw / name).write_text("\n".join([header, *lines]) + "\n")
    whole, damaged = split_rows(spark, "meter_readings", str(raw), str(tmp_path / "out"))
    rows = damaged.collect()
    assert whole.count() + len(rows) == sum(map(len, files.values()))
    assert sorted(r["row_text"] for r in rows) == sorted(bad)
    for r in rows:
        name = r["file"].rsplit("/", 1)[1]
        assert r["block"] == 0 and files[name][r["line"]] == r["row_text"]
    assert "_corrupt_record" not in whole.columns and whole.where("kwh IS NULL").count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        split_rows(spark, "meter_readings", str(raw), str(tmp_path / "out"))


def test_blocks_count_their_own_rows(spark, tmp_path):
    """A file cut into blocks, several in one task: places are unique and within their block."""
    from wattledger.sources.readers import split_rows

    header = "timestamp,meter_id,district_id,meter_type,kwh,voltage,power_factor"
    lines = [f"2024-06-01 00:00:00,m{i},d1,residential,{'much' if i % 5 == 0 else '1.0'},240.0,0.9" for i in range(2000)]
    (tmp_path / "raw.csv").write_text("\n".join([header, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        whole, damaged = split_rows(spark, "meter_readings", str(tmp_path / "raw.csv"), str(tmp_path / "out"))
        rows = damaged.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert whole.count() == 1600 and len(rows) == 400
    blocks = sorted({r["block"] for r in rows})
    assert len(blocks) > 3 and len({(r["block"], r["line"]) for r in rows}) == 400
    # the rows of a block follow those of the block before
    starts = {}
    for block in blocks:
        starts[block] = min(int(r["row_text"].split(",m")[1].split(",")[0]) - r["line"] for r in rows if r["block"] == block)
    for r in rows:
        assert starts[r["block"]] + r["line"] == int(r["row_text"].split(",m")[1].split(",")[0])
