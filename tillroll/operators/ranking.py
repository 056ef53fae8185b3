"""Top-k overall, top-k per group, and an exact distributed ``ntile``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import col
from tillroll.sources import files


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in ``order``: sort + limit, which Spark plans as a
    per-task top-n followed by a merge of at most ``tasks x n`` rows
    (``TakeOrderedAndProject``), never a full sort.  Give a unique
    tie-break in ``order`` for a deterministic answer."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    rank_name: str = "rank",
) -> DataFrame:
    """First ``n`` rows of every group by ``row_number``.

    The rank filter sits directly on the window, so Spark adds a partial
    ``WindowGroupLimit`` before the shuffle: each task forwards at most
    ``n`` rows per group, so a group holding most of the rows does not
    land whole in one task.
    """
    w = Window.partitionBy(*group).orderBy(*[col(c) for c in order])
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= n)


def _cut_before(key: Column, tie: Column, ascending: bool, k: str = "k"):
    """Predicate on a cut struct (k, t): the cut row sorts before this row
    (nulls first ascending, last descending; ties by ``tie``)."""

    def before(c: Column) -> Column:
        if ascending:
            first = F.coalesce(c[k] < key, c[k].isNull() & key.isNotNull())
        else:
            first = F.coalesce(c[k] > key, c[k].isNotNull() & key.isNull())
        return first | (c[k].eqNullSafe(key) & (c["t"] < tie))

    return before


def _dealt(df: DataFrame, tiebreak: str, specs: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """A row for each row of ``df`` and ordering, in the orderings' order one
    after another: dealt by ranges once, sorted in tasks and written once.

    ``_o`` is the ordering, ``_k<o>`` its key (null in other orderings' rows),
    ``_t`` the tie-break, ``_at`` the row's place (task << 33 | place in the
    task); the first ordering's rows carry the whole row in ``_row``."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    kinds = {c: f.dataType for f, c in zip(df.schema.fields, df.columns)}

    def entry(o: int) -> Column:
        keys = [(F.col(key) if i == o else F.lit(None).cast(kinds[key])).alias(f"_k{i}") for i, (_, key, _) in enumerate(specs)]
        row = whole if o == 0 else F.when(F.lit(False), whole)
        return F.struct(F.lit(o).alias("_o"), *keys, row.alias("_row"))

    rows = df.select(F.explode(F.array(*[entry(o) for o in range(len(specs))])).alias("_e"), F.col(tiebreak).alias("_t")).select("_e.*", "_t")
    order = [F.col("_o")]
    order += [F.asc_nulls_first(f"_k{i}") if asc else F.desc_nulls_last(f"_k{i}") for i, (_, _, asc) in enumerate(specs)]
    order.append(F.col("_t").asc())
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return files.materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")


def _cut_rows(ranged: DataFrame, k: int, orderings: int) -> Column:
    """The rows that end tiles 1..k-1 of every ordering, as one array (a
    scalar subquery): ``_dealt``'s rows at given places of the whole order."""
    part = F.shiftright("_at", 33).alias("_part")
    # as many rows as tasks
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows_each = F.floor(F.sum("_n").over(whole) / F.lit(orderings)).cast("long")
    placed = sizes.select("_part", "_n", F.sum("_n").over(up_to).alias("_end"), rows_each.alias("_all"))
    # Cut j ends tile j: rank j*q + min(j, r), q = n div k, r = n mod k,
    # behind the n rows of each ordering before.
    q = F.floor(F.col("_all") / F.lit(k)).cast("long")
    r = F.col("_all") - q * F.lit(k)
    j, o = F.col("_j").cast("long"), F.col("_ordering").cast("long")
    ranks = placed.select("*", F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("_j"))
    ranks = ranks.select("*", F.explode(F.sequence(F.lit(0), F.lit(orderings - 1))).alias("_ordering"))
    ranks = ranks.withColumn("_c", o * F.col("_all") + j * q + F.least(j, r))
    wanted = ranks.where((F.col("_c") <= F.col("_end")) & (F.col("_c") > F.col("_end") - F.col("_n"))).select(
        (F.shiftleft("_part", 33) + F.col("_c") - (F.col("_end") - F.col("_n")) - 1).alias("_at")
    )
    found = ranged.drop("_row").join(F.broadcast(wanted.distinct()), "_at")
    keys = [F.col(f"_k{i}").alias(f"k{i}") for i in range(orderings)]
    return found.agg(F.collect_list(F.struct(F.col("_o").alias("o"), *keys, F.col("_t").alias("t")))).scalar()


def global_ntile(
    df: DataFrame, k: int, key: str, tiebreak: str, ascending: bool = True, out: str = "tile"
) -> DataFrame:
    """``ntile(k) over (order by key [asc|desc], tiebreak asc)`` over all
    rows; see ``global_ntiles``."""
    return global_ntiles(df, k, tiebreak, [(out, key, ascending)])


def global_ntiles(df: DataFrame, k: int, tiebreak: str, specs: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """Exact ``ntile(k)`` over all rows for several orderings at once, with
    no single-partition window over the rows, at every size.

    ``specs`` lists ``(out, key, ascending)``; every ordering is ``key``
    (SQL null placement: first ascending, last descending) then
    ``tiebreak`` ascending, which should make the order unique.

    tile = 1 + (number of tile-ending rows before the row), and only those
    ``k-1`` rows per ordering are looked for, all in one selection: the
    orderings are laid one after another, (ordering, key, tie-break) is dealt
    by ranges in one exchange -- the tie-break splits a value that most rows
    share -- sorted within tasks and written with each row's task and place;
    the tasks' row counts (a row each) say which places the tile ends are.
    The first ordering's rows carry the whole rows, so that the result is a
    projection of the written table: every row compares itself with the
    ``k-1`` cut rows of an ordering, from one scalar subquery, so ``k`` is
    meant to be a number of quantiles.

    Rows are written once, to the session's shared folder, so this function
    starts a job.
    """
    specs = list(specs)
    if k == 1 or not specs:
        return df.select("*", *[F.lit(1).alias(o) for o, _, _ in specs])
    ranged = _dealt(df, tiebreak, specs)
    result = ranged.where("_o = 0").select("_row", _cut_rows(ranged, k, len(specs)).alias("_cuts"))

    def tile(o: int, key: str, asc: bool) -> Column:
        before = _cut_before(F.col("_row")[key], F.col("_row")[tiebreak], asc, f"k{o}")
        return (F.lit(1) + F.size(F.filter("_cuts", lambda c: (c["o"] == o) & before(c)))).cast("int")

    return result.select("_row.*", *[tile(o, key, asc).alias(name) for o, (name, key, asc) in enumerate(specs)])
