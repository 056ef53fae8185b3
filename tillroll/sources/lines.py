"""Sale lines from plain text, with the lines that can't be read kept apart.

Every line of the text is either a sale line or a rejected line with a
reason; headers are neither.  A quoted field can't hold a line break here
(``files.read_sales_csv`` reads those).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources import schema as S
from tillroll.sources.files import materialize, remove

LINE, REASON = "line", "reason"
_BROKEN = "_broken"
_TEXT = T.StructType([*[T.StructField(f.name, T.StringType()) for f in S.SALES_SCHEMA], T.StructField(_BROKEN, T.StringType())])
#: How a customer id may be written: a whole number, with or without a zero fraction.
_WHOLE = r"^\s*([0-9]+)(?:\.0*)?\s*$"


def _typed(name: str) -> Column:
    raw = F.col(f"_given.{name}")
    if name == S.INVOICE_DATE:
        return F.try_to_timestamp(raw, F.lit(S.TIMESTAMP_FORMAT)).cast("timestamp_ntz")
    if name == S.CUSTOMER_ID:
        return F.regexp_extract(raw, _WHOLE, 1).try_cast("bigint")
    if name == S.PRICE:
        return raw.try_cast(S.CSV_PRICE)
    if name == S.QUANTITY:
        return raw.try_cast("int")
    return raw


def read_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """The sale columns, ``line`` (the text) and ``reason``: null for a sale
    line, else ``fields`` for a line whose fields can't be told apart or
    counted, or the name of the first column whose value is none of its type.
    ``header`` is the text of header lines, which are left out; by default the
    columns' names joined by commas, quoted or not."""
    names = [f.name for f in S.SALES_SCHEMA]
    headers = [header] if header is not None else [",".join(names), ",".join(f'"{n}"' for n in names)]
    text = spark.read.text(path).select(F.col("value").alias(LINE)).where(~F.col(LINE).isin(headers))
    options = {k: S.CSV_OPTIONS[k] for k in ("escape", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace", "emptyValue", "nullValue")}
    given = F.from_csv(LINE, _TEXT.simpleString()[7:-1].replace(":", " "), {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    rows = text.select(LINE, F.explode(F.array(given)).alias("_given"))  # no filter is pushed into it: a line is parsed once
    typed = rows.select(LINE, "_given", *[_typed(n).alias(n) for n in names])
    reason = F.when(F.col(f"_given.{_BROKEN}").isNotNull() | F.col("_given").isNull(), "fields")
    for n in names:
        reason = reason.when(F.col(f"_given.{n}").isNotNull() & F.col(n).isNull(), n)
    return typed.select(*names, LINE, reason.alias(REASON))


def accepted(lines: DataFrame) -> DataFrame:
    """The sale lines."""
    return lines.where(F.col(REASON).isNull()).select(*S.SALES_COLUMNS)


def rejected(lines: DataFrame) -> DataFrame:
    """(line, reason) of the others."""
    return lines.where(F.col(REASON).isNotNull()).select(LINE, REASON)


def write_split(lines: DataFrame, good: str, bad: str) -> None:
    """Both outputs as tables of their own.  The lines are read and parsed in
    one pass, into a table that has a sale line's columns or else its text."""
    taken = F.col(REASON).isNull()
    parts = [F.when(taken, F.col(c)).alias(c) for c in S.SALES_COLUMNS]
    once = materialize(lines.select(*parts, F.when(~taken, F.col(LINE)).alias(LINE), REASON), "lines-read")
    accepted(once).write.mode("overwrite").parquet(good)
    rejected(once).write.mode("overwrite").parquet(bad)
    remove(once)
