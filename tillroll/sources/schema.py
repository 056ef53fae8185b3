"""Column names, types and reader options of the sale-line fact table.

One sale line per row. Money is ``decimal(12,2)`` so that sums are exact and
independent of the order in which partial sums are merged; operators cast to
``double`` only on output.
"""

from __future__ import annotations

from pyspark.sql import types as T

INVOICE = "invoice"
STOCK_CODE = "stock_code"
DESCRIPTION = "description"
QUANTITY = "quantity"
INVOICE_DATE = "invoice_date"
PRICE = "price"
CUSTOMER_ID = "customer_id"
COUNTRY = "country"
REVENUE = "revenue"

MONEY = T.DecimalType(12, 2)

SALES_SCHEMA = T.StructType(
    [
        T.StructField(INVOICE, T.StringType(), True),
        T.StructField(STOCK_CODE, T.StringType(), True),
        T.StructField(DESCRIPTION, T.StringType(), True),
        T.StructField(QUANTITY, T.IntegerType(), True),
        T.StructField(INVOICE_DATE, T.TimestampNTZType(), True),
        T.StructField(PRICE, MONEY, True),
        T.StructField(CUSTOMER_ID, T.LongType(), True),
        T.StructField(COUNTRY, T.StringType(), True),
    ]
)

SALES_COLUMNS = tuple(f.name for f in SALES_SCHEMA.fields)

# Text format of the CSV copy (header row, this timestamp
# pattern, unparsable fields become NULL and are removed by cleaning).
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "timestampFormat": TIMESTAMP_FORMAT,
    "mode": "PERMISSIVE",
    "multiLine": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
    "nullValue": "\\N",
}
# What a price is read as: more digits than money is kept in, no rounding.
CSV_PRICE = T.DecimalType(18, 6)

# Spark task-end events as written to an event log (JSON lines). Only the
# fields the run-metrics job reads are declared; everything else is skipped
# by the reader instead of being inferred.
TASK_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("Event", T.StringType(), True),
        T.StructField("Stage ID", T.LongType(), True),
        T.StructField(
            "Task Metrics",
            T.StructType(
                [
                    T.StructField("Peak Execution Memory", T.LongType(), True),
                    T.StructField(
                        "Shuffle Read Metrics",
                        T.StructType(
                            [
                                T.StructField("Remote Bytes Read", T.LongType(), True),
                                T.StructField("Local Bytes Read", T.LongType(), True),
                            ]
                        ),
                        True,
                    ),
                    T.StructField(
                        "Shuffle Write Metrics",
                        T.StructType(
                            [T.StructField("Shuffle Bytes Written", T.LongType(), True)]
                        ),
                        True,
                    ),
                ]
            ),
            True,
        ),
    ]
)

# Job-start events: which stages a job ran, and its properties (the job
# description names the work it belongs to).
JOB_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("Event", T.StringType(), True),
        T.StructField("Job ID", T.LongType(), True),
        T.StructField("Stage IDs", T.ArrayType(T.LongType()), True),
        T.StructField("Properties", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

# One row per (query, api, run): the benchmark's run-metrics table.
RUN_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType(), True),
        T.StructField("api", T.StringType(), True),
        T.StructField("run_index", T.IntegerType(), True),
        T.StructField("runtime_seconds", T.DoubleType(), True),
        T.StructField("result_rows", T.LongType(), True),
        T.StructField("shuffle_read_bytes", T.LongType(), True),
        T.StructField("shuffle_write_bytes", T.LongType(), True),
        T.StructField("peak_memory_bytes", T.LongType(), True),
        T.StructField("notes", T.StringType(), True),
    ]
)
