import json
import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.fixtures import plan_text
from tillroll.operators import metrics
from tillroll.operators.cleaning import clean
from tillroll.plans import queries as Q
from tillroll.sources import eventlog, files
from tillroll.sources import schema as S
from tillroll.sources.star import sales_from_star


def test_star_source_schema(spark):
    df = sales_from_star(spark, SF001)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in S.SALES_SCHEMA.fields]


def test_csv_copy_gives_the_same_rows(spark):
    raw = sales_from_star(spark, SF001)
    path = files.fresh_path(spark, "test-csv")
    files.write_sales_csv(raw, path)
    back = files.read_sales(spark, path, fmt="csv")
    assert raw.exceptAll(back).count() == 0 and back.exceptAll(raw).count() == 0


def test_year_partitioned_copy_prunes_directories(spark):
    raw = sales_from_star(spark, SF001)
    path = files.fresh_path(spark, "test-by-year")
    files.write_by_year(raw, path)
    years = sorted(d for d in os.listdir(path) if d.startswith("year="))
    assert years[0] == "year=1995" and len(years) >= 6
    pruned = files.read_sales(spark, path, fmt="parquet", years=[1996])
    assert {f.rsplit("/", 2)[1] for f in pruned.inputFiles()} == {"year=1996"}
    by_string = [ln for ln in plan_text(spark.read.parquet(path).filter("year = 1996")).splitlines()
                 if ln.startswith("PartitionFilters")]
    assert by_string and "1996" in by_string[0]  # a SQL-string filter on the partition column prunes too
    expect = raw.where(F.year("invoice_date") == 1996)
    assert pruned.exceptAll(expect).count() == 0 and expect.exceptAll(pruned).count() == 0


def test_registered_layout_queries_match_q03(spark):
    a = Q.csv_source_roundtrip(spark, SF001)
    b = Q.q03_revenue_by_country_month(spark, SF001)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = Q.partitioned_write_pruned_read(spark, SF001)
    d = b.where(F.col("year").isin(1996, 1997))
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_shared_dir_is_the_sessions_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert files.shared_dir(spark) == configured.rstrip("/")
    else:
        assert os.path.isdir(files.shared_dir(spark))


def test_event_log_metrics(spark):
    events = [
        {"Event": "SparkListenerTaskEnd", "Task Metrics": {"Peak Execution Memory": 100,
         "Shuffle Read Metrics": {"Remote Bytes Read": 5, "Local Bytes Read": 7},
         "Shuffle Write Metrics": {"Shuffle Bytes Written": 11}}},
        {"Event": "SparkListenerTaskEnd", "Task Metrics": {"Peak Execution Memory": 300}},
        {"Event": "SparkListenerJobStart", "Job ID": 1},
    ]
    d = tempfile.mkdtemp(prefix="tillroll-evlog-")
    with open(os.path.join(d, "app-1"), "w") as f:
        for e in events:
            f.write(json.dumps(e) + "\n")
        f.write("{broken line\n")
    with open(os.path.join(d, "app-2"), "w") as f:
        f.write(json.dumps(events[0]) + "\n")
    out = {
        os.path.basename(r["log_file"]): (r["shuffle_read_bytes"], r["shuffle_write_bytes"], r["peak_memory_bytes"])
        for r in metrics.event_log_metrics(eventlog.read_task_events(spark, d)).collect()
    }
    assert out == {"app-1": (12, 11, 300), "app-2": (12, 11, 100)}


def run_rows(spark):
    rows = []
    for q, times in {"q01": (1.0, 0.5, 3.0), "q02": (0.2, 0.4, 2.0), "q03": (0.9, 0.9, 5.0)}.items():
        for api, t in zip(("dataframe", "sql", "rdd"), times):
            for i, jitter in enumerate((0.0, 0.1, -0.05)):
                rows.append((q, api, i, t + jitter, 10, 0, 2048 * (i + 1), 1048576 * (i + 1), ""))
    return spark.createDataFrame(rows, S.RUN_METRICS_SCHEMA)


def test_runtime_medians_best_and_wins(spark):
    med = metrics.runtime_medians(run_rows(spark))
    got = {r["query_id"]: (r["dataframe"], r["sql"], r["rdd"], r["best_api"]) for r in med.collect()}
    assert got["q01"] == (1.0, 0.5, 3.0, "sql")
    assert got["q02"][3] == "dataframe"
    assert got["q03"][3] == "dataframe"  # tie: first in report order
    wins = {r["best_api"]: r["wins"] for r in metrics.wins_per_api(med).collect()}
    assert wins == {"dataframe": 2, "sql": 1}


def test_shuffle_memory_medians(spark):
    out = {r["query_id"]: (r["shuffle_write_kb"], r["peak_memory_mb"]) for r in
           metrics.shuffle_memory_medians(run_rows(spark)).collect()}
    assert out["q01"] == (4.0, 2.0)


def test_run_metrics_csv_append_roundtrip(spark):
    path = files.fresh_path(spark, "test-metrics")
    rows = run_rows(spark)
    eventlog.append_run_metrics(rows, path)
    eventlog.append_run_metrics(rows.limit(3), path)
    assert eventlog.read_run_metrics_csv(spark, path).count() == rows.count() + 3


def test_clean_on_csv_equals_clean_on_parquet(spark):
    raw = sales_from_star(spark, SF001)
    path = files.fresh_path(spark, "test-csv2")
    files.write_sales_csv(raw, path)
    a = clean(files.read_sales(spark, path, fmt="csv"))
    b = clean(raw)
    assert a.count() == b.count()


def test_queries_over_the_prepared_copy_equal_the_star_queries(spark):
    from tillroll.sources.star import region_lookup_from_star

    copy = Q.prepare_sales(spark, SF001)
    lookup = region_lookup_from_star(spark, SF001)
    for label, form in Q.FORMS.items():
        a = form(Q.cleaned_from_copy(spark, copy), lookup)
        b = form(Q.cleaned(spark, SF001), lookup)
        assert a.columns == b.columns, label
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, label
    window = Q.cleaned_from_copy(spark, copy, "1996-03-01 00:00:00", "1997-02-28 23:59:59")
    assert {f.rsplit("/", 2)[1] for f in window.inputFiles()} == {"year=1996", "year=1997"}


def test_csv_malformed_lines(spark):
    path = files.fresh_path(spark, "test-bad-csv")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(",".join(S.SALES_COLUMNS) + "\n")
        f.write("1,5,red widget,2,1996-01-01 10:00:00,3.50,9,NATION_1\n")
        f.write("2,5,red widget,two,1996-01-01 10:00:00,3.50,9,NATION_1\n")
        f.write("3,5,red widget,2,not a date,3.50,9,NATION_1\n")
    permissive = files.read_sales(spark, path, fmt="csv")
    assert permissive.count() == 3 and clean(permissive).count() == 1
    dropped = files.read_sales(spark, path, fmt="csv", mode="DROPMALFORMED")
    assert [r["invoice"] for r in dropped.collect()] == ["1"]


def test_csv_keeps_commas_quotes_and_nulls(spark):
    from tests.fixtures import line, sales

    rows = [
        line(invoice="1", description='lamp, "large"'),
        line(invoice="2", description=None, customer_id=None),
        line(invoice="3", description="plain", price="0.01"),
        line(invoice="4", description=" two\nlines \\ ", invoice_date="1996-05-01 10:00:00.123456"),
        line(invoice="5", description="", stock_code="79323P"),
    ]
    df = sales(spark, rows)
    path = files.fresh_path(spark, "test-csv-quotes")
    files.write_sales_csv(df, path)
    back = files.read_sales(spark, path, fmt="csv")
    assert sorted(back.collect()) == sorted(df.collect())


def test_metrics_by_job_description(spark):
    def task(stage, written, peak):
        return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task Metrics": {
            "Peak Execution Memory": peak, "Shuffle Write Metrics": {"Shuffle Bytes Written": written}}}

    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0, 1], "Properties": {"spark.job.description": "q1"}},
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Stage IDs": [1, 2], "Properties": {"spark.job.description": "q2"}},
        {"Event": "SparkListenerJobStart", "Job ID": 2, "Stage IDs": [3], "Properties": {}},
        task(0, 10, 5), task(1, 20, 7), task(2, 40, 3), task(3, 1000, 1000),
    ]
    d = tempfile.mkdtemp(prefix="tillroll-evlog-")
    with open(os.path.join(d, "app"), "w") as f:
        f.write("\n".join(json.dumps(e) for e in events) + "\n")
    out = metrics.metrics_by_job_description(eventlog.read_task_events(spark, d), eventlog.read_job_starts(spark, d))
    got = {r["description"]: (r["shuffle_write_bytes"], r["peak_memory_bytes"]) for r in out.collect()}
    assert got == {"q1": (30, 7), "q2": (40, 3)}  # stage 1 counted once, for the first job; untagged job left out


def test_year_copy_without_adaptive_execution(spark):
    raw = sales_from_star(spark, SF001)
    path = files.fresh_path(spark, "test-by-year-no-aqe")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        files.write_by_year(raw, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    back = files.read_sales(spark, path, fmt="parquet")
    assert raw.exceptAll(back).count() == 0 and back.exceptAll(raw).count() == 0


def test_year_copy_splits_large_years(spark):
    # several upstream tasks, as any input of real size has: AQE splits a
    # partition at map-output boundaries
    raw = sales_from_star(spark, "/root/testdata/sf0.01").repartition(8)
    path = files.fresh_path(spark, "test-by-year-split")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        files.write_by_year(raw, path)
    finally:
        spark.conf.set(key, old)
    per_year = {d: len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")])
                for d in os.listdir(path) if d.startswith("year=")}
    assert per_year and min(per_year.values()) > 1, per_year  # each year written by several tasks


def test_csv_of_a_retail_export(spark):
    path = files.fresh_path(spark, "test-retail-csv")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n")
        f.write('489434,79323P,"PINK CHERRY, LIGHTS",12,2009-12-01 07:45:00,6.75,13085.0,United Kingdom\n')
        f.write("489435,22041,PLAIN,1,2009-12-01 07:46:00,0.004,13085,France\n")
        f.write('489436,22041,"two\nlines",2,2009-12-01 07:46:00,1.5,12.5,France\n')
        f.write("489437,22041,,2,2009-12-01 07:46:00,1.5,,France\n")
        f.write("489438,22041,BAD,x,2009-12-01 07:46:00,1.5,7,France\n")
    df = files.read_sales(spark, path, fmt="csv")
    assert df.count() == 5
    kept = {r["invoice"]: (r["stock_code"], r["customer_id"], float(r["price"])) for r in clean(df).collect()}
    assert kept == {"489434": ("79323P", 13085, 6.75), "489435": ("22041", 13085, 0.004)}
    top = Q.q04_form(clean(df)).collect()
    assert [r["stock_code"] for r in top] == ["79323P", "22041"]


def test_metrics_of_a_rolled_log(spark):
    def task(stage, written):
        return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task Metrics": {
            "Peak Execution Memory": 1, "Shuffle Write Metrics": {"Shuffle Bytes Written": written}}}

    start = {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0], "Properties": {"spark.job.description": "q"}}
    d = os.path.join(tempfile.mkdtemp(prefix="tillroll-evlog-"), "eventlog_v2_app-1")
    os.makedirs(d)
    for i, events in enumerate([[start, task(0, 10)], [task(0, 100)]], 1):
        with open(os.path.join(d, f"events_{i}_app-1"), "w") as f:
            f.write("".join(json.dumps(e) + "\n" for e in events))
    tasks = eventlog.read_task_events(spark, os.path.dirname(d))
    assert [r["shuffle_write_bytes"] for r in metrics.event_log_metrics(tasks).collect()] == [110]
    by = metrics.metrics_by_job_description(tasks, eventlog.read_job_starts(spark, os.path.dirname(d)))
    assert [(r["description"], r["shuffle_write_bytes"]) for r in by.collect()] == [("q", 110)]


def test_released_folder_is_gone(spark):
    table = files.materialize(spark.range(3), "gone")
    files.remove(table)
    assert not files.exists(spark, table.written_to)
    files.materialize(spark.range(3), "gone")
    folder = files.application_folder(spark)
    files.release(spark)
    assert not files.exists(spark, folder)
