"""Sliding per-account counts and sums over the trailing 1 h and 24 h, both ends included.

Every row enters a window at its own time and leaves it one microsecond after ``t + w``, so
the sliding figures are running sums over entry and exit marks: one sort and one pass, where
a RANGE frame would re-add the whole frame for each row. Amounts are summed as decimals, so
the order of addition does not matter.

One account may hold a large share of all rows. Accounts above ``hot_rows`` are cut into
time slices that run in parallel. A slice of a day or more starts from marks of the rows that
reach into it, so the rows are read once; only where a day of one account is above ``hot_rows``
are slices shorter, and start from the totals of the slices before them, which takes a second
pass. Rows without a time have slices of their own. The list of such accounts has at most one row
for each ``hot_rows`` rows; it is fetched when the plan is made, which decides what is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.parsing import is_blank
from tallyward.operators.dedup import latest_per_key

HOUR = 3600
DAY = 86400
HOT_ROWS = 500_000
SPREAD = 1024  # groups for rows without an account

_MICROS = 10**6
_REACH = DAY * _MICROS + 1  # from a row's entry to the last of its exits
_SUM = "decimal(28,2)"
FIGURES = (
    "transactions_last_1h", "transactions_last_24h", "amount_last_1h", "amount_last_24h",
    "avg_amount_24h",
)


def _marks(amount: Column, at: Column, start: Column | None = None) -> Column:
    """Entry and exit marks of one row, with what each adds to the four running figures. ``start`` is
    the time where the next slice starts from the rows still inside; NULL if the row is not."""
    a = F.coalesce(amount.cast(_SUM), F.lit(0).cast(_SUM))
    zero = F.lit(0).cast(_SUM)

    def mark(when, is_row, c1, c24, a1, a24):
        return F.struct(
            when.alias("at"), F.lit(is_row).alias("is_row"), c1.cast("int").alias("c1"),
            c24.cast("int").alias("c24"), a1.cast(_SUM).alias("a1"), a24.cast(_SUM).alias("a24"),
        )

    one, none = F.lit(1), F.lit(0)
    marks = F.array(
        mark(at, True, one, one, a, a),
        mark(at + F.lit(HOUR * _MICROS + 1), False, -one, none, -a, zero),
        mark(at + F.lit(_REACH), False, none, -one, zero, -a),
    )
    if start is None:
        return marks
    in_1h = at + F.lit(HOUR * _MICROS + 1) >= start
    again = mark(start, False, F.when(in_1h, one).otherwise(none), one, F.when(in_1h, a).otherwise(zero), a)
    return F.when(start.isNull(), marks).otherwise(F.concat(marks, F.array(again)))


def _slice_of(at: Column) -> Column:
    """Number of the slice at a time, without rounding."""
    since = at - F.col("_first")
    return ((since - F.pmod(since, F.col("_width"))) / F.col("_width")).cast("bigint")


def _keys(account: str, ts: str) -> dict[str, Column]:
    """Account (NULL where blank) and time in microseconds (0 where missing)."""
    return {
        "_acct": F.when(~is_blank(account), F.col(account)),
        "_at": F.coalesce(F.unix_micros(F.col(ts)), F.lit(0)).cast("bigint"),
    }


def hot_accounts(df: DataFrame, account: str = "account_number", ts: str = "transaction_date",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Accounts to slice, with the first of their times, their slice width and whether it is under a day.

    Counted with a map-side combine over two columns. Any table with the accounts' rows will
    do, such as yesterday's facts: the list decides how work is cut, never the figures.
    """
    timed = F.when(F.col("_timed"), F.col("_at"))
    stats = (
        df.select(*[e.alias(n) for n, e in _keys(account, ts).items()], F.col(ts).isNotNull().alias("_timed"))
        .filter(F.col("_acct").isNotNull())
        .groupBy("_acct")
        .agg(F.count("*").alias("n"), F.coalesce(F.min(timed), F.lit(0)).alias("first"),
             F.coalesce(F.max(timed), F.lit(0)).alias("last"))
        .filter(F.col("n") > hot_rows)
    )
    span = F.col("last") - F.col("first")
    width = F.greatest(F.lit(1), F.floor(span * (hot_rows / 4.0) / F.col("n"))).cast("bigint")
    dense = (width < _REACH) & (F.col("n") * (_REACH / hot_rows) > span)
    return stats.select(
        F.col("_acct").alias("_hot"), F.col("first").alias("_first"),
        F.when(dense, width).otherwise(F.greatest(width, F.lit(_REACH))).alias("_width"), dense.alias("_dense"))


def velocity(
    df: DataFrame,
    account: str = "account_number",
    ts: str = "transaction_date",
    amount: str = "amount",
    txn_id: str = "transaction_id",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Append the five figures to every row of ``df``.

    ``hot`` is a list from ``hot_accounts``, run here; without one, ``df`` itself is counted first,
    which runs what is behind it once more.

    A row without an account counts only itself. Rows without a time share the time 0.
    ``txn_id`` must be unique: deduplicate first, or an update counts twice.
    """
    if hot is None:
        hot = hot_accounts(df, account, ts, hot_rows)
    sliced = hot.collect()  # at most one row for each ``hot_rows`` rows
    keyed = df.withColumns(_keys(account, ts))
    if sliced:
        listed = T.StructType([T.StructField(f.name, f.dataType) for f in hot.schema])
        cuts = F.broadcast(df.sparkSession.createDataFrame(sliced, listed))
        keyed = keyed.join(cuts, F.col("_acct") == F.col("_hot"), "left")
    else:
        keyed = keyed.withColumns({f.name: F.lit(None).cast(f.dataType) for f in hot.schema})
    next_slice = F.col("_first") + (_slice_of(F.col("_at")) + 1) * F.col("_width")
    start = F.when(~F.col("_dense") & (F.col("_at") + F.lit(_REACH) >= next_slice), next_slice)

    # The row's columns stay at top level, so that those nobody reads are pruned before the
    # shuffle; only the entry mark carries them.
    marks = keyed.select(
        "_acct", "_hot", "_first", "_width", "_dense",
        F.xxhash64(txn_id).alias("_spread"),
        F.explode(
            F.when(F.col("_acct").isNull(), F.slice(_marks(F.col(amount), F.col("_at")), 1, 1))
            .otherwise(_marks(F.col(amount), F.col("_at"), start if sliced else None))
        ).alias("m"),
        *df.columns,
    ).select(
        "_acct",
        F.coalesce("_dense", F.lit(False)).alias("_is_dense"),
        F.when(F.col("_acct").isNull(), F.pmod("_spread", F.lit(SPREAD)))
        .when(F.col("_hot").isNull(), F.lit(0))
        .otherwise(_slice_of(F.col("m.at")))
        .cast("bigint").alias("_slice"),
        *[F.col("m")[c].alias(f"_m_{c}") for c in ("at", "is_row", "c1", "c24", "a1", "a24")],
        *[F.when(F.col("m.is_row"), F.col(c)).alias(c) for c in df.columns],
    )

    dense = any(r["_dense"] for r in sliced)
    if dense:
        marks = marks.join(_carry(marks), ["_acct", "_slice"], "left")
    w = (
        Window.partitionBy("_acct", "_slice").orderBy("_m_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def running(name):
        inside = F.sum(f"_m_{name}").over(w)
        return inside + F.coalesce(F.col(f"_{name}"), F.lit(0)) if dense else inside

    out = marks.select(
        "_acct", "_m_is_row", *df.columns,
        *[running(n).alias(f"_r_{n}") for n in ("c1", "c24", "a1", "a24")],
    ).filter("_m_is_row")
    own = F.coalesce(F.col(amount).cast(_SUM), F.lit(0).cast(_SUM))
    alone = F.col("_acct").isNull()
    return out.select(
        *df.columns,
        F.when(alone, 1).otherwise(F.col("_r_c1")).cast("int").alias(FIGURES[0]),
        F.when(alone, 1).otherwise(F.col("_r_c24")).cast("int").alias(FIGURES[1]),
        F.when(alone, own).otherwise(F.col("_r_a1")).cast("decimal(18,2)").alias(FIGURES[2]),
        F.when(alone, own).otherwise(F.col("_r_a24")).cast("decimal(18,2)").alias(FIGURES[3]),
        F.when(alone, own)
        .otherwise(F.round(F.col("_r_a24").cast("decimal(24,2)") / F.col("_r_c24"), 2))
        .cast("decimal(18,2)").alias(FIGURES[4]),
    )


def _carry(marks: DataFrame) -> DataFrame:
    """Totals before each slice of the accounts whose slices are shorter than a day."""
    totals = (
        marks.filter("_is_dense")
        .groupBy("_acct", "_slice")
        .agg(*[F.sum(f"_m_{n}").alias(n) for n in ("c1", "c24", "a1", "a24")])
    )
    before = (
        Window.partitionBy("_acct").orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        "_acct", "_slice",
        *[F.sum(n).over(before).alias(f"_{n}") for n in ("c1", "c24", "a1", "a24")],
    )


def velocity_of_batch(batch: DataFrame, history: DataFrame, **names) -> DataFrame:
    """Figures for a micro-batch against stored rows.

    ``history`` holds earlier rows (account, time, amount and id are enough). Only the last
    24 h of the batch's accounts are used. Rows of the batch replace stored rows of the same
    transaction; of several stored rows the one with the largest ``version`` counts, where
    ``history`` has that column. So an update or a replay is counted once.
    """
    if "version" in history.columns:
        history = latest_per_key(history, names.get("txn_id", "transaction_id"), [F.col("version").desc_nulls_last()])
    account = names.get("account", "account_number")
    ts = names.get("ts", "transaction_date")
    amount = names.get("amount", "amount")
    txn_id = names.get("txn_id", "transaction_id")
    reach = batch.groupBy(account).agg(
        (F.min(ts) - F.expr(f"INTERVAL {DAY} SECONDS")).alias("_since")
    )
    past = (
        history.select(account, ts, amount, txn_id)
        .join(reach, account, "inner")
        .filter(F.col(ts) >= F.col("_since"))
        .join(batch.select(txn_id), txn_id, "left_anti")
        .drop("_since")
        .withColumn("_is_new", F.lit(False))
    )
    both = batch.withColumn("_is_new", F.lit(True)).unionByName(past, allowMissingColumns=True)
    return velocity(both, **names).filter("_is_new").drop("_is_new")


def velocity_quality(df: DataFrame) -> DataFrame:
    """Share of rows whose 1 h and 24 h counts differ (all equal means broken times)."""
    differs = F.col("transactions_last_1h") != F.col("transactions_last_24h")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(differs.cast("int")), F.lit(0)).alias("n_different"),
        F.round(F.avg(differs.cast("double")), 6).alias("share_different"),
    )
