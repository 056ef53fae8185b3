"""Small helpers shared by the operators: column names, written tables and
orderings that are numbered without a single-task window."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.files import materialize

DOC_ID, TEXT = "doc_id", "text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Workers that Spark starts from now on find this
    package where the driver has it (a cluster has it installed, or gets it
    by --py-files)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def no_text(text: str | Column = TEXT) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def extended(df: DataFrame, fields: dict[str, T.DataType]) -> T.StructType:
    """The schema of ``df`` with more fields."""
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in fields.items()]])


def wide_key(*values: Column) -> Column:
    """A 128-bit key of the values, as text: two hashes of different seeds.
    (Of 3e10 documents, two dozen pairs share a 64-bit key.)"""
    return F.concat_ws("-", *[F.xxhash64(F.lit(lane), *values) for lane in (0, 1)])


def content_key(df: DataFrame, columns: list[str] | None = None) -> Column:
    """128-bit key of a row's content, as text.  Rows that are equal in every
    column share it; it is the same however often a task is run again."""
    cols = [F.col(f"`{c}`") for c in (columns or sorted(df.columns))]
    return wide_key(*[x for c in cols for x in (c.isNull(), c.cast("string"))])


def numbered(df: DataFrame, order: list[str], name: str, per: str | None = None, add: str | None = None) -> DataFrame:
    """``df`` in the given order with ``<name>``: rows (or the sum of ``add``)
    before each row, within each value of ``per`` where that is given.

    The rows are dealt by ranges of ``order`` (which starts with ``per``), so
    a value holding most rows spreads over many tasks; each task numbers its
    own rows while they stream by, and the tasks' totals -- a row for each
    task and value it holds -- are summed up and joined back.  The order has
    to be total up to equal rows for repeatable numbers.
    """
    part, key = unused(df, "_part", "_per")
    least = F.lit(-(2**63)).cast("long")  # stands for null
    base = df.withColumn(key, F.coalesce(F.col(per).cast("long"), least) if per else F.lit(0).cast("long"))
    schema = extended(base, {name: T.LongType(), part: T.IntegerType()})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen: int | None = None
        total = 0
        for b in batches:
            n = b.num_rows
            keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            step = b.column(b.schema.get_field_index(add)).to_numpy(zero_copy_only=False).astype("int64") if add else np.ones(n, "int64")
            before = np.cumsum(step) - step
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.zeros(0, "int64")
            lens = np.diff(np.r_[first, n])
            out = before - np.repeat(before[first], lens)
            if n and keys[0] == seen:
                out[: lens[0]] += total
            if n:
                seen, total = keys[-1], int(out[-1] + step[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(out, pa.int64()), pa.array(np.full(n, task, "int32"))],
                names=[*b.schema.names, name, part],
            )

    ranged = base.repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(ranged.mapInArrow(number, schema), name)
    ends = local.groupBy(key, part).agg(F.max(F.col(name) + (F.col(add) if add else F.lit(1))).alias("n"))
    # Only a value that goes on from an earlier task needs an offset, and a
    # task's first value alone can: at most as many rows as tasks.
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = unused(local, "_before")[0]
    offsets = ends.select(key, part, F.sum("n").over(earlier).alias(start)).where(F.col(start) > 0)
    return (
        local.join(F.broadcast(offsets), [key, part], "left")
        .withColumn(name, F.col(name) + F.coalesce(F.col(start), F.lit(0)))
        .drop(key, part, start)
    )
