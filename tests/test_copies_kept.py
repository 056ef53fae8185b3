"""Clustered and pruned copies, scans over ranges, kept tables, hot lookup
keys, rejected lines and batches of run metrics."""

import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.fixtures import executed_plan_text, line, plan_text, sales
from tillroll.operators import aggregates, enrich, kept, trend
from tillroll.operators.cleaning import clean
from tillroll.plans import queries as Q
from tillroll.plans import sql_surface
from tillroll.sources import calendar, eventlog, files, lines
from tillroll.sources import schema as S
from tillroll.sources.star import region_lookup_from_star, sales_from_star


@pytest.fixture(scope="module")
def copy(spark):
    return Q.prepare_sales(spark, SF001)


@pytest.fixture()
def conf(spark):
    """Sets session settings for a test."""
    old = {}

    def put(**kw):
        for k, v in kw.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- clustered copy --------------------------------------------------------------


def test_clustered_self_join_has_no_exchange(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    got = Q.q09_clustered_copy(spark, SF001)
    plan = executed_plan_text(got)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert rows(got) == rows(Q.q09_month_over_month(spark, SF001))


def test_clustered_copy_is_a_file_for_each_bucket(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    path = files.fresh_path(spark, "clustered")
    files.write_clustered(df, path, "k", 4, ["v"])
    again = files.read_clustered(spark, path, df.schema, "k", 4, ["v"])
    assert rows(again) == rows(df) and len(again.inputFiles()) <= 4
    assert rows(files.read_clustered(spark, path, df.schema, "k", 4, ["v"])) == rows(df)  # known already
    per_key = executed_plan_text(again.groupBy("k").count())
    assert "Exchange" not in per_key


def test_clustered_step_and_gaps(spark):
    months = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (1, 8, 4), (2, 9, 1), (2, 10, 7), (None, 1, 1), (None, 2, 1)], "customer_id long, month_index int, month_spend int")
    plain = trend.period_over_period(months)
    assert rows(trend.period_over_period(months, clustered=True)) == rows(plain)
    assert rows(trend.period_over_period(months, step=2, clustered=True)) == [(1, 8, 4.0, 2.0, 2.0)]


# -- pruned reads ------------------------------------------------------------------


@pytest.mark.parametrize(
    ("start", "end", "filters"),
    [("1996-03-01 00:00:00", None, ["year#\\d+ >= 1996"]), (None, "1995-06-30 23:59:59", ["year#\\d+ <= 1995"]), ("1994-05-01 00:00:00", "1996-01-31 00:00:00", ["year#\\d+ >= 1994", "year#\\d+ <= 1996"])],
)
def test_windows_open_on_a_side_prune_years(spark, copy, start, end, filters):
    got = Q.cleaned_from_copy(spark, copy, start, end)
    parts = re.search(r"PartitionFilters: (.*)", plan_text(got))[1]
    assert all(re.search(f, parts) for f in filters)
    assert rows(got) == rows(clean(sales_from_star(spark, SF001), start, end))


def test_join_on_a_calendar_prunes_at_run_time(spark, copy):
    sold = files.read_sales(spark, copy, keep_year=True)
    leap = calendar.years(spark, 1900, 2100).where("days = 366")
    got = calendar.in_years(sold, leap)
    plan = executed_plan_text(got)
    assert "dynamicpruning" in re.search(r"PartitionFilters: (.*)", plan)[1]
    assert {r.year for r in got.select("year").distinct().collect()} <= set(range(1900, 2101, 4))
    assert rows(got.select(*S.SALES_COLUMNS)) == rows(sales_from_star(spark, SF001).where("year(invoice_date) % 4 = 0"))


def test_calendar(spark):
    got = {r.year: (r.days, r.first_weekday) for r in calendar.years(spark, 1999, 2001).collect()}
    assert got == {1999: (365, 4), 2000: (366, 5), 2001: (365, 0)}


def test_year_of_either_copy(spark, copy):
    path = files.fresh_path(spark, "csv-years")
    files.write_sales_csv(sales_from_star(spark, SF001), path)
    a = files.read_sales(spark, path, fmt="csv", since=1995, until=1996, keep_year=True)
    b = files.read_sales(spark, copy, since=1995, until=1996, keep_year=True)
    assert a.groupBy("year").count().orderBy("year").collect() == b.groupBy("year").count().orderBy("year").collect()
    assert files.read_sales(spark, copy).columns == list(S.SALES_COLUMNS)


# -- running totals over ranges ---------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("trailing", [1, 3, 40])
def test_scan_over_ranges_equals_the_window(spark, conf, seed, trailing):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="7")
    rng = random.Random(seed)
    n = rng.choice([0, 1, 25, 300])
    data = [(i, rng.choice([None, rng.randrange(5)]), None if rng.random() < (0.95 if seed == 3 else 0.1) else Decimal(rng.randrange(-500, 500)) / 100) for i in range(n)]
    df = spark.createDataFrame(data, "id long, day int, v decimal(12,2)")
    got = trend.running_stats_by_range(df, "v", ["day", "id"], trailing)
    want = trend.running_stats(df, "v", ["day", "id"], trailing)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert "SinglePartition" not in plan_text(got)


def test_scan_of_whole_numbers(spark):
    df = spark.range(1000).select(F.col("id").alias("v"))
    got = {r.v: (r.cumulative, r.moving_avg) for r in trend.running_stats_by_range(df, "v", ["v"]).collect()}
    assert all(got[i] == (i * (i + 1) / 2, max(i - 1, i / 2)) for i in range(1000))


# -- quintiles in one selection -------------------------------------------------------------


def test_several_orderings_take_one_range_exchange(spark):
    plans = []
    keep = files.materialize

    def seen(df, name, **kw):
        plans.append(plan_text(df, "simple"))
        return keep(df, name, **kw)

    files.materialize = seen
    try:
        Q.q10_rfm_segments(spark, SF001)
    finally:
        files.materialize = keep
    assert len(plans) == 1 and plans[0].count("rangepartitioning") == 1


def test_sql_quintiles_use_no_operator(spark, monkeypatch):
    from tillroll.operators import ranking

    monkeypatch.setattr(ranking, "global_ntiles", None)
    monkeypatch.setattr(files, "materialize", None)
    assert sql_surface.sql_q10(spark, SF001).count() > 0


# -- kept tables ----------------------------------------------------------------------------


def test_kept_tables_give_the_same_answers(spark, copy):
    path = files.fresh_path(spark, "kept")
    years = kept.refresh(spark, copy, path)
    assert years == sorted(r.year for r in files.read_sales(spark, copy, keep_year=True).select("year").distinct().collect())
    assert kept.refresh(spark, copy, path) == []
    assert rows(kept.summary(spark, path)) == rows(Q.q02_summary(spark, SF001))
    assert rows(kept.revenue_by_month(spark, path)) == rows(Q.q03_revenue_by_country_month(spark, SF001))
    assert rows(kept.revenue_by_region(spark, path, region_lookup_from_star(spark, SF001))) == rows(Q.q08_region_lookup_join(spark, SF001))
    for df in (kept.summary(spark, path), kept.revenue_by_region(spark, path, region_lookup_from_star(spark, SF001))):
        assert "Expand" not in plan_text(df)


def test_only_changed_years_are_written(spark):
    def copy_of(*lines_):
        files.write_by_year(sales(spark, lines_), at)

    at, path = files.fresh_path(spark, "small-copy"), files.fresh_path(spark, "small-kept")
    old = [line(invoice=str(i), invoice_date=f"{y}-02-03 00:00:00", customer_id=i % 3, quantity=2) for i in range(9) for y in (1995, 1996, 1997)]
    copy_of(*old)
    assert kept.refresh(spark, at, path) == [1995, 1996, 1997]
    before = {f for f in kept.read_kept(spark, path, "spend").inputFiles() if "year=1997" not in f}
    # one year changes: its folder alone is replaced
    more = sales(spark, [line(invoice="a7", invoice_date="1997-05-05 00:00:00", customer_id=5), line(invoice="007", invoice_date="1997-06-05 00:00:00", customer_id=5)])
    more.withColumn("year", F.lit(1997)).write.mode("append").partitionBy("year").parquet(at)
    assert kept.refresh(spark, at, path) == [1997]
    assert before <= set(kept.read_kept(spark, path, "spend").inputFiles())
    whole = clean(files.read_sales(spark, at))
    assert rows(kept.summary(spark, path)) == rows(aggregates.summary(whole))
    got = kept.summary(spark, path).first()
    assert (got.distinct_invoices, got.distinct_customers) == (11, 4)  # 7, a7 and 007 are three
    # a year goes, another loses all its valid lines
    files.delete(spark, f"{at}/year=1995")
    files.delete(spark, f"{at}/year=1996")
    sales(spark, [line(invoice="C1", invoice_date="1996-05-05 00:00:00")]).withColumn("year", F.lit(1996)).write.mode("append").partitionBy("year").parquet(at)
    assert kept.refresh(spark, at, path) == [1996]
    assert rows(kept.summary(spark, path)) == rows(aggregates.summary(clean(files.read_sales(spark, at))))


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_count_exactly(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([None, 0, -1, -40_000, rng.randrange(10**6), rng.randrange(50), 2**40 + rng.randrange(9)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, part int, id long")
    sets = kept.bitmaps(df, ["g", "part"], "id")
    want = df.groupBy("g").agg(F.countDistinct("id").alias("distinct"))
    assert rows(kept.distinct_of(sets, ["g"])) == rows(want)
    assert kept.distinct_of(sets).first()[0] == len({x[2] for x in data} - {None})
    assert kept.distinct_of(sets.limit(0)).first()[0] == 0


# -- hot lookup keys ---------------------------------------------------------------------------


def test_hot_lookup_join_equals_the_plain_join(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="20")
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 5 + ["warm"] * 2 + [None, "gone"] + [f"k{rng.randrange(400)}"] * 6), i) for i in range(6000)]
    fact = spark.createDataFrame(data, "code string, n long")
    dim = spark.createDataFrame([("hot", "H"), ("warm", "W"), *[(f"k{i}", f"v{i}") for i in range(0, 400, 2)]], "code string, label string")
    for default in (None, "?"):
        got = enrich.hot_lookup_join(fact, dim, "code", "label", default, hot_part=50)
        assert rows(got.select("code", "n", "label")) == rows(enrich.lookup_join(fact, dim, "code", "label", default).select("code", "n", "label"))
    # what is shuffled by the key has no hot key left
    shuffled = [r for r in Counter(x[0] for x in data).items() if r[0] is not None and r[1] * 50 <= sum(x[0] is not None for x in data)]
    assert max(n for _, n in shuffled) <= 6000 / 50 and len(shuffled) > 300
    plan = plan_text(got)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    tasks = got.select(F.spark_partition_id().alias("p"), "code").where("code like 'k%'").groupBy("p").count().collect()
    assert max(r["count"] for r in tasks) < 600
    assert enrich.hot_lookup_join(fact.limit(0), dim, "code", "label").count() == 0


# -- rejected lines --------------------------------------------------------------------------------


def test_every_line_is_accepted_or_rejected(spark, tmp_path):
    head = ",".join(S.SALES_COLUMNS)
    good = ['1,a,"red, big",2,1996-01-02 03:04:05,2.50,13085.0,UK', "2,b,,1,1996-01-02 03:04:05,0.123456,7,UK", '"3","c","say ""hi""",-1,1996-01-02 03:04:05.5,1,\\N,']
    bad = {
        "too few,fields": "fields", "1,a,x,2,1996-01-02 03:04:05,2.50,7,UK,more": "fields", "1,a,x,two,1996-01-02 03:04:05,2.50,7,UK": "quantity",
        "1,a,x,2,1996-13-02 03:04:05,2.50,7,UK": "invoice_date", "1,a,x,2,1996-01-02 03:04:05,cheap,7,UK": "price", "1,a,x,2,1996-01-02 03:04:05,2.50,7.5,UK": "customer_id",
        "1,a,x,99999999999,1996-01-02 03:04:05,2.50,7,UK": "quantity",
    }
    for i, part in enumerate((good + list(bad), good[:1])):
        (tmp_path / f"part{i}.csv").write_text("\n".join([head, *part]) + "\n")
    read = lines.read_lines(spark, str(tmp_path))
    assert sorted((r.line, r.reason) for r in lines.rejected(read).collect()) == sorted(bad.items())
    taken = lines.accepted(read)
    assert taken.count() == 4 and taken.count() + lines.rejected(read).count() == read.count()
    first = taken.where("invoice = '1'").first()
    assert (first.description, first.customer_id, first.quantity) == ("red, big", 13085, 2)
    third = taken.where("invoice = '3'").first()
    assert third.description == 'say "hi"' and third.customer_id is None
    a, b = files.fresh_path(spark, "a"), files.fresh_path(spark, "b")
    lines.write_split(read, a, b)
    assert spark.read.parquet(a).count() == 4 and spark.read.parquet(b).count() == len(bad)


def test_a_line_is_parsed_once(spark, tmp_path):
    texts = ["1,a,x,2,1996-01-02 03:04:05,2.50,7,UK", "1,a,x,two,1996-01-02 03:04:05,2.50,7,UK", "too few"]
    (tmp_path / "lines.csv").write_text("\n".join(texts) + "\n")
    read = lines.read_lines(spark, str(tmp_path))
    for part in (lines.accepted(read), lines.rejected(read)):  # a filter on the reason would repeat the parser
        assert plan_text(part, "simple").count("from_csv(") == 1
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    a, b = files.fresh_path(spark, "a"), files.fresh_path(spark, "b")
    lines.write_split(read.mapInArrow(counted, read.schema), a, b)
    assert seen.value == len(texts)  # both tables from one pass
    assert spark.read.parquet(a).count() == 1
    assert sorted(rows(spark.read.parquet(b))) == [("1,a,x,two,1996-01-02 03:04:05,2.50,7,UK", "quantity"), ("too few", "fields")]


def test_one_tasks_lines_go_to_several_csv_files(spark):
    n, path = 1_100_000, files.fresh_path(spark, "one-task")
    given = {S.INVOICE: F.col("id").cast("string"), S.DESCRIPTION: F.lit("two\nlines"), S.QUANTITY: F.lit(1)}
    df = spark.range(n).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.SALES_SCHEMA]).coalesce(1)
    files.write_sales_csv(df, path)
    back = files.read_sales_csv(spark, path)
    by_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(by_file) == n and max(by_file) <= 500_000
    assert back.agg(F.countDistinct(S.INVOICE)).first()[0] == n


def test_lines_agree_with_the_csv_reader(spark):
    path = files.fresh_path(spark, "lines-csv")
    files.write_sales_csv(sales_from_star(spark, SF001), path)
    read = lines.read_lines(spark, path)
    assert lines.rejected(read).count() == 0
    assert rows(lines.accepted(read)) == rows(files.read_sales_csv(spark, path).select(*S.SALES_COLUMNS))


# -- run metrics in batches -------------------------------------------------------------------------


def test_a_repeated_batch_adds_nothing(spark):
    df = spark.createDataFrame([("q1", "sql", i, 0.5, 3, 0, 0, 0, "") for i in range(3)], S.RUN_METRICS_SCHEMA)
    path, out = files.fresh_path(spark, "batches"), files.fresh_path(spark, "one-csv")
    names = ["a/b", "..", "__HIVE_DEFAULT_PARTITION__", "é", "a%2Fb"]
    assert all(eventlog.append_run_metrics(df, path, n) for n in names)
    assert not any(eventlog.append_run_metrics(df, path, n) for n in names)
    # a batch broken off before its mark is written anew
    files.delete(spark, f"{path}/batch-%C3%A9/_SUCCESS")
    assert eventlog.append_run_metrics(df.limit(1), path, "é")
    assert eventlog.append_run_metrics(df, path)
    assert eventlog.read_run_metrics_csv(spark, path).count() == 3 * 4 + 1 + 3
    eventlog.export_run_metrics(spark, path, out)
    text = [r.value for r in spark.read.text(out).collect()]
    assert len(text) == 17 and sum(t.startswith("query_id,") for t in text) == 1
