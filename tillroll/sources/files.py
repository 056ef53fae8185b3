"""File copies of the sale-line table: CSV with an explicit schema and a
``year``-partitioned Parquet layout with pruned reads.

Paths handed to these functions must be on storage every executor sees.
``shared_dir`` returns such a folder: the session's ``spark.checkpoint.dir``
when the cluster names one; only a ``local[...]`` session without it (tests)
gets a fresh folder of our own, a cluster session without it is an error.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources import schema as S

YEAR = "year"
#: Lines in a CSV file at most: one task reads a whole file, as quoted fields may hold line breaks.
CSV_FILE_LINES = 500_000

_local_fallback: str | None = None
_folders: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables, shared by the cluster."""
    global _local_fallback
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach "
            "(written tables and checkpoints go there)"
        )
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="tillroll-")
    return _local_fallback


def _located(spark: SparkSession, path: str):
    """The path as Hadoop sees it, and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _located(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder; nothing there is fine."""
    at, fs = _located(spark, path)
    fs.delete(at, True)


def application_folder(spark: SparkSession) -> str:
    """This application's folder under ``shared_dir``.  It is removed when
    the interpreter ends, or earlier by ``release``."""
    path = f"{shared_dir(spark)}/tillroll-{spark.sparkContext.applicationId}"
    if path not in _folders:
        _folders[path] = _located(spark, path)
        if len(_folders) == 1:
            atexit.register(_release_all)
    return path


def release(spark: SparkSession) -> None:
    """Removes every table that this application's calls have written; frames
    they returned can't be read afterwards."""
    at, fs = _folders.pop(application_folder(spark))
    fs.delete(at, True)


def _release_all() -> None:
    for at, fs in _folders.values():
        with contextlib.suppress(Exception):  # the JVM may be gone
            fs.delete(at, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location in the application's folder (one per write)."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def read_sales_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with a header of any names, columns in the order of the schema;
    the explicit schema avoids an inference pass.

    Stock codes are text.  Customer ids are read as text and taken if they
    are whole numbers, with or without a zero fraction (``13085.0``).  Prices
    keep six digits.  ``PERMISSIVE`` turns unparsable fields into NULL
    (cleaning then drops the line); ``DROPMALFORMED`` drops lines with a
    wrong field count or a failed parse already in the reader."""
    given = T.StructType(
        [T.StructField(f.name, {S.PRICE: S.CSV_PRICE, S.CUSTOMER_ID: T.StringType()}.get(f.name, f.dataType)) for f in S.SALES_SCHEMA]
    )
    raw = spark.read.options(**{**S.CSV_OPTIONS, "mode": mode}).schema(given).csv(path)
    whole = F.regexp_extract(S.CUSTOMER_ID, r"^\s*([0-9]+)(?:\.0*)?\s*$", 1).try_cast("bigint")
    return raw.withColumn(S.CUSTOMER_ID, whole)


def write_sales_csv(df: DataFrame, path: str) -> None:
    """Every value is quoted, NULL is written ``\\N``: blanks, quotes, line
    breaks, empty texts and fractions of a second are read back as they were.
    A task with many lines writes several files, which are read apart."""
    (
        df.select(*S.SALES_COLUMNS)
        .write.mode("overwrite")
        .options(header="true", timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS", quoteAll="true", escape='"', emptyValue="")
        .options(nullValue="\\N", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .option("maxRecordsPerFile", CSV_FILE_LINES)
        .csv(path)
    )


def write_by_year(df: DataFrame, path: str, date_col: str = S.INVOICE_DATE) -> None:
    """Parquet copy with one ``year=`` directory per calendar year.

    Rows are rebalanced on the year before the write (the ``REBALANCE``
    hint): one shuffle that groups a year's rows into few tasks, while AQE
    splits any partition beyond the advisory size -- a year holding a third
    of the rows is written by many tasks -- and merges small ones.  Files
    come out near ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    instead of tasks x years small files, and no task gets a whole year.

    With adaptive execution off, ``REBALANCE`` could not split a hot year,
    so each task then sorts its own rows by year and writes without a
    shuffle (more, smaller files, but no task gets a whole year).
    """
    out = df.withColumn(YEAR, F.year(date_col))
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    out = out.hint("rebalance", YEAR) if adaptive else out.sortWithinPartitions(YEAR)
    out.write.mode("overwrite").partitionBy(YEAR).parquet(path)


def read_sales_parquet(
    spark: SparkSession, path: str, years: Iterable[int] | None = None, since: int | None = None, until: int | None = None
) -> DataFrame:
    """Read the year-partitioned copy, with its ``year`` column.  With
    ``years``, only those years' directories are listed and read; ``since``
    and ``until`` (either or both) are filters on the partition column, so
    that other years' files aren't read.  The schema is declared."""
    reader = spark.read.schema(T.StructType([*S.SALES_SCHEMA.fields, T.StructField(YEAR, T.IntegerType())]))
    if years is None:
        df = reader.parquet(path)
    else:
        folders = [f for y in sorted({int(y) for y in years}) if exists(spark, f := f"{path}/{YEAR}={y}")]
        if not folders:
            return reader.parquet(path).where(F.lit(False))
        df = reader.option("basePath", path).parquet(*folders)
    if since is not None:
        df = df.where(F.col(YEAR) >= int(since))
    if until is not None:
        df = df.where(F.col(YEAR) <= int(until))
    return df


def read_sales(
    spark: SparkSession, path: str, fmt: str = "parquet", years: Iterable[int] | None = None, mode: str = "PERMISSIVE",
    since: int | None = None, until: int | None = None, keep_year: bool = False,
) -> DataFrame:
    """Source switch by parameter: the same sale lines from either copy.
    ``keep_year`` adds the year, the partition column of the Parquet copy: a
    filter on it prunes directories, and a join on it with a filtered table
    that is broadcast prunes them at run time."""
    if fmt == "parquet":
        df = read_sales_parquet(spark, path, years, since, until)
        return df if keep_year else df.select(*S.SALES_COLUMNS)
    if fmt == "csv":
        df = read_sales_csv(spark, path, mode).withColumn(YEAR, F.year(S.INVOICE_DATE))
        if years is not None:
            df = df.where(F.col(YEAR).isin([int(y) for y in years]))
        if since is not None:
            df = df.where(F.col(YEAR) >= int(since))
        if until is not None:
            df = df.where(F.col(YEAR) <= int(until))
        return df if keep_year else df.select(*S.SALES_COLUMNS)
    raise ValueError(f"unknown format {fmt!r}")


def write_clustered(df: DataFrame, path: str, key: str, buckets: int, sort: Iterable[str] = ()) -> None:
    """Parquet copy in ``buckets`` buckets by ``key``, a file each, sorted by
    ``key`` and ``sort``.  Joins and aggregates of such copies on the key need
    no exchange.  A key lies in one file, so ``df`` should be reduced (a few
    rows for a key) before: a hot key would be a hot file."""
    name = f"tillroll_write_{uuid.uuid4().hex}"
    order = [key, *sort]
    dealt = df.repartition(buckets, key)  # the buckets' own hash: a task writes one bucket
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # external: the files stay


def read_clustered(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int, sort: Iterable[str] = ()) -> DataFrame:
    """A copy written by ``write_clustered``, in any session: an external
    table over its files, named after the path, tells Spark of the buckets."""
    name = "tillroll_clustered_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    order = ", ".join(f"`{c}`" for c in [key, *sort])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY (`{key}`) SORTED BY ({order}) INTO {buckets} BUCKETS"
    )
    return spark.table(name)


def materialize(df: DataFrame, name: str, single_file: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under ``shared_dir`` and read it back.

    Cuts the lineage in one job (an RDD checkpoint would compute its input
    twice) on storage that survives executor loss; the re-read table also
    carries its true size, so later broadcast decisions are made on
    measured rather than estimated bytes.  ``single_file`` is for tables
    that are small by construction (bounded summaries): one task writes
    them.  The schema is handed to the reader, so no footer is inspected.
    """
    path = fresh_path(df.sparkSession, name)
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove(table: DataFrame) -> None:
    """Deletes what ``materialize`` wrote for ``table``, which nothing may
    read any more."""
    at, fs = _located(table.sparkSession, table.written_to)
    fs.delete(at, True)
