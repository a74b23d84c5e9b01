"""Runs whose results appear together, and that take up where an earlier start broke off.

Each run has a folder of its own, ``<out_dir>/runs/<run_id>``, with its intermediate tables, its results and a manifest: one
entry for each finished result, with its rows, written after the result. A second start of the run reads the tables that
are finished, skips the results that the manifest has, and does the rest.

Readers follow ``<out_dir>/published``, whose latest entry names a run. It is written when all results of that run are
finished, so they see all of them or those of the run before, never a mixture. Runs are not written again once published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.plans.full_run import OUTPUTS, Run, analyze, read_saved, save_one
from wattledger.plans.storage import is_written, resumable

RAW_TABLES = ("meter_readings", "plant_output", "weather")
MANIFEST = "name STRING, rows BIGINT"


def run_folder(out_dir: str, run_id: str) -> str:
    return f"{out_dir}/runs/{run_id}"


def _file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _one_row(spark: SparkSession, path: str, schema: str, *values) -> None:
    spark.createDataFrame([values], schema).coalesce(1).write.mode("overwrite").parquet(path)


def _state_of_inputs(run: Run) -> str:
    """A digest of names, sizes and times of all raw files: a run is not taken up over other data."""
    entries = []
    for table in RAW_TABLES:
        path, fs = _file_system(run.spark, f"{run.raw_dir}/{table}.{run.raw_format}")
        files = fs.listFiles(path, True)
        while files.hasNext():
            file = files.next()
            entries.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    state = run.spark.createDataFrame(sorted(entries), "path STRING, size BIGINT, modified BIGINT")
    lines = F.sort_array(F.collect_list(F.concat_ws(" ", "path", "size", "modified")))
    return state.agg(F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("digest")).first()["digest"]


def publish_run(run: Run, run_id: str, on_finished: Callable[[str], None] = lambda name: None) -> None:
    """Do what is left of run ``run_id`` below ``run.out_dir``, and publish it when all its results are finished.

    on_finished is called after each result, with its name; if it raises, the run stops there. A run over raw files that
    changed since its first start is refused; a published run is left as it is.
    """
    spark, base = run.spark, run_folder(run.out_dir, run_id)
    if is_written(spark, f"{base}/complete"):
        return
    state = _state_of_inputs(run)
    if not is_written(spark, f"{base}/inputs"):
        _one_row(spark, f"{base}/inputs", "digest STRING", state)
    elif spark.read.parquet(f"{base}/inputs").first()["digest"] != state:
        raise ValueError(f"the raw files of run {run_id} have changed since it began")
    results = analyze(*(run.raw(table) for table in RAW_TABLES), folder=f"{base}/work", write=resumable)
    for name in OUTPUTS:
        if not is_written(spark, f"{base}/manifest/{name}"):
            rows = save_one(name, results[name], base, run.out_format, run.single_files)
            _one_row(spark, f"{base}/manifest/{name}", MANIFEST, name, rows)
            on_finished(name)
    latest = _latest(spark, run.out_dir)
    _one_row(spark, f"{run.out_dir}/published/{(latest or 0) + 1:09d}", "run_id STRING", run_id)
    _one_row(spark, f"{base}/complete", "run_id STRING", run_id)
    work, fs = _file_system(spark, f"{base}/work")
    fs.delete(work, True)


def _latest(spark: SparkSession, out_dir: str) -> int | None:
    """The highest number of a finished entry; entries that broke off do not count."""
    path, fs = _file_system(spark, f"{out_dir}/published")
    if not fs.exists(path):
        return None
    names = sorted((s.getPath().getName() for s in fs.listStatus(path)), reverse=True)
    return next((int(name) for name in names if is_written(spark, f"{out_dir}/published/{name}")), None)


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    """The run that readers see now; none before the first is complete."""
    latest = _latest(spark, out_dir)
    return None if latest is None else spark.read.parquet(f"{out_dir}/published/{latest:09d}").first()["run_id"]


def manifest(spark: SparkSession, out_dir: str, run_id: str) -> DataFrame:
    """name and rows of each finished result of a run."""
    folder = f"{run_folder(out_dir, run_id)}/manifest"
    paths = [f"{folder}/{name}" for name in OUTPUTS if is_written(spark, f"{folder}/{name}")]
    return spark.read.schema(MANIFEST).parquet(*paths) if paths else spark.createDataFrame([], MANIFEST)


def read_published(spark: SparkSession, out_dir: str, name: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    """A result of the published run. The frame stays with that run when another is published."""
    run_id = published_run(spark, out_dir)
    if run_id is None:
        raise ValueError(f"nothing is published in {out_dir}")
    return read_saved(spark, run_folder(out_dir, run_id), name, schema, fmt)
