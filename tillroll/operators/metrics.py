"""Run-metrics jobs: shuffle / memory totals from event logs and the
benchmark summary tables (medians, best interface, wins), as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The interfaces compared by the benchmark, in report order.
APIS = ("dataframe", "sql", "rdd")


def event_log_metrics(task_events: DataFrame, app_col: str = "log_file") -> DataFrame:
    """Per application (event-log file): shuffle bytes read (remote +
    local), shuffle bytes written, and the largest peak execution memory
    of any task.  Missing sub-structures count as zero."""
    tm = F.col("Task Metrics")
    read = F.coalesce(tm["Shuffle Read Metrics"]["Remote Bytes Read"], F.lit(0)) + F.coalesce(
        tm["Shuffle Read Metrics"]["Local Bytes Read"], F.lit(0)
    )
    written = F.coalesce(tm["Shuffle Write Metrics"]["Shuffle Bytes Written"], F.lit(0))
    peak = F.coalesce(tm["Peak Execution Memory"], F.lit(0))
    return task_events.groupBy(app_col).agg(
        F.sum(read).cast("bigint").alias("shuffle_read_bytes"),
        F.sum(written).cast("bigint").alias("shuffle_write_bytes"),
        F.max(peak).cast("bigint").alias("peak_memory_bytes"),
    )


def metrics_by_job_description(
    task_events: DataFrame, job_starts: DataFrame, prop: str = "spark.job.description"
) -> DataFrame:
    """M1 per unit of work inside one application: task metrics summed per
    job description (set with ``SparkContext.setJobDescription``).  Stages
    are mapped to descriptions through the job-start events; a stage shared
    by several jobs is counted once, for the first of them."""
    stage_owner = (
        job_starts.select(
            "log_file",
            F.col("Job ID").alias("job_id"),
            F.col("Properties").getItem(prop).alias("description"),
            F.explode("Stage IDs").alias("stage_id"),
        )
        .where(F.col("description").isNotNull())
        .groupBy("log_file", "stage_id")
        .agg(F.min_by("description", "job_id").alias("description"))
    )
    same_stage = (task_events["Stage ID"] == stage_owner["stage_id"]) & (
        task_events["log_file"] == stage_owner["log_file"]
    )
    tagged = task_events.join(stage_owner, same_stage).drop(stage_owner["log_file"])
    return event_log_metrics(tagged, "description")


def runtime_medians(runs: DataFrame, apis: Sequence[str] = APIS) -> DataFrame:
    """Median runtime per query, one column per interface (pivot over the
    fixed interface list, so no extra pass discovers the values), plus the
    fastest interface (first in ``apis`` order on a tie)."""
    wide = runs.groupBy("query_id").pivot("api", list(apis)).agg(F.median("runtime_seconds"))
    best_time = F.least(*[F.col(a) for a in apis])
    best = F.lit(None).cast("string")
    for a in reversed(apis):
        best = F.when(F.col(a) == best_time, F.lit(a)).otherwise(best)
    return wide.withColumn("best_api", best).orderBy("query_id")


def shuffle_memory_medians(runs: DataFrame, api: str = "dataframe") -> DataFrame:
    """Median shuffle write (KiB) and peak memory (MiB) of one interface's
    runs, per query."""
    return (
        runs.where(F.col("api") == F.lit(api))
        .groupBy("query_id")
        .agg(
            (F.median(F.col("shuffle_write_bytes").cast("double")) / F.lit(1024.0)).alias("shuffle_write_kb"),
            (F.median(F.col("peak_memory_bytes").cast("double")) / F.lit(1024.0 * 1024.0)).alias("peak_memory_mb"),
        )
        .orderBy("query_id")
    )


def wins_per_api(medians: DataFrame) -> DataFrame:
    """How many queries each interface was fastest on."""
    return medians.groupBy("best_api").agg(F.count(F.lit(1)).alias("wins")).orderBy(F.desc("wins"), "best_api")
