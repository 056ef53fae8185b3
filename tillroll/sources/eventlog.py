"""Spark event logs (JSON lines) and run-metrics tables as DataFrames."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import files
from tillroll.sources import schema as S

TASK_END = "SparkListenerTaskEnd"
JOB_START = "SparkListenerJobStart"


def _application() -> F.Column:
    """The log's application: the folder of a rolled log, whose files are its
    segments, else the file."""
    name = F.input_file_name()
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(.*/eventlog_v2_[^/]+)/", 1), F.lit("")), name)


def read_task_events(spark: SparkSession, path: str) -> DataFrame:
    """Task-end events of one or many event-log files, with their file name.

    The schema is declared, so no inference pass runs over the logs; broken
    lines are dropped (``DROPMALFORMED``) and events of other kinds are
    filtered out.
    """
    return (
        spark.read.schema(S.TASK_EVENT_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", "true")
        .json(path)
        .where(F.col("Event") == F.lit(TASK_END))
        .withColumn("log_file", _application())
    )


def read_job_starts(spark: SparkSession, path: str) -> DataFrame:
    """Job-start events (stage ids and properties) of event-log files."""
    return (
        spark.read.schema(S.JOB_EVENT_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", "true")
        .json(path)
        .where(F.col("Event") == F.lit(JOB_START))
        .withColumn("log_file", _application())
    )


def read_run_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """The run metrics in ``path`` and in its batches."""
    return spark.read.option("header", "true").option("recursiveFileLookup", "true").schema(S.RUN_METRICS_SCHEMA).csv(path)


def append_run_metrics(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Appends rows to the run-metrics table (CSV files with a header each).

    With ``batch``, the rows are a batch of that name and are added once: a
    batch that has been committed (its folder bears Spark's ``_SUCCESS``
    mark) adds nothing, one that was broken off is written anew.  The name is
    escaped, so any text will do.  True if the rows were added."""
    rows = df.select(*S.RUN_METRICS_SCHEMA.fieldNames())
    if batch is None:
        rows.write.mode("append").option("header", "true").csv(path)
        return True
    folder = f"{path}/batch-{quote(batch, safe='').replace('.', '%2E')}"
    if files.exists(df.sparkSession, f"{folder}/_SUCCESS"):
        return False
    rows.write.mode("overwrite").option("header", "true").csv(folder)
    return True


def export_run_metrics(spark: SparkSession, path: str, out: str) -> None:
    """The whole table as one CSV file with one header, in the order of
    query, interface and run (a row for each run of a benchmark)."""
    rows = read_run_metrics_csv(spark, path).coalesce(1).sortWithinPartitions("query_id", "api", "run_index")
    rows.write.mode("overwrite").option("header", "true").csv(out)
