"""Type-2 history: versions from snapshots, incremental apply, point-in-time lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.dedup import latest_per_key

OPEN_END = "9999-12-31"


def scd2_history(snapshots: DataFrame, key: str, hash_col: str = "scd2_hash",
                 on: str = "snapshot_date", order: str = "load_ts") -> DataFrame:
    """Versions per key from dated snapshots.

    Several rows of a key on one day collapse to the last one first, so a key never brings
    more rows to the window than there are days. A version ends the day before the next.
    """
    daily = latest_per_key(snapshots, [key, on], [F.col(order).desc_nulls_last()])
    w = Window.partitionBy(key).orderBy(on)
    changed = (
        daily.withColumn("_previous", F.lag(hash_col).over(w))
        .filter(F.col("_previous").isNull() | (F.col("_previous") != F.col(hash_col)))
        .drop("_previous")
    )
    following = F.lead(on).over(w)
    return changed.withColumns({
        "effective_date": F.col(on),
        "expiry_date": F.date_sub(following, 1),
        "is_current": following.isNull(),
    }).drop(on, order)


def scd2_changes(staged: DataFrame, current: DataFrame, key: str,
                 hash_col: str = "scd2_hash") -> DataFrame:
    """Staged rows whose key is new or whose tracked columns changed."""
    known = current.select(key, F.col(hash_col).alias("_known"))
    return (
        staged.join(known, key, "left")
        .filter(F.col("_known").isNull() | (F.col("_known") != F.col(hash_col)))
        .drop("_known")
    )


def scd2_apply(dimension: DataFrame, staged: DataFrame, key: str, as_of: str,
               hash_col: str = "scd2_hash") -> DataFrame:
    """Close changed rows the day before ``as_of``, add the new versions, keep the rest.

    A second change on the same day replaces the version opened that day. Keys absent from
    ``staged`` stay open. Closed rows pass through untouched.
    """
    day = F.lit(as_of).cast("date")
    fresh = scd2_changes(staged, dimension.filter("is_current"), key, hash_col).withColumns({
        "effective_date": day, "expiry_date": F.lit(None).cast("date"), "is_current": F.lit(True),
    })
    newest = staged.select(key, F.col(hash_col).alias("_newest"))
    closes = F.col("is_current") & F.coalesce(F.col("_newest") != F.col(hash_col), F.lit(False))
    kept = (
        dimension.join(newest, key, "left")
        .filter(~(closes & (F.col("effective_date") >= day)))
        .withColumns({
            "expiry_date": F.when(closes, F.date_sub(day, 1)).otherwise(F.col("expiry_date")),
            "is_current": F.col("is_current") & ~closes,
        })
        .drop("_newest")
    )
    return kept.unionByName(fresh.select(*kept.columns))


def point_in_time_join(fact: DataFrame, dim: DataFrame, key: str, ts: str,
                       fields: list[str]) -> DataFrame:
    """Add the fields of the version valid on the fact's day; both ends count."""
    versions = dim.select(
        key, F.col("effective_date").alias("_from"),
        F.coalesce("expiry_date", F.lit(OPEN_END).cast("date")).alias("_to"), *fields,
    ).alias("d")
    f = fact.alias("f")
    on_day = F.to_date(F.col(f"f.{ts}"))
    condition = (F.col(f"f.{key}") == F.col(f"d.{key}")) & on_day.between(
        F.col("d._from"), F.col("d._to")
    )
    return f.join(versions, condition, "left").select("f.*", *[f"d.{c}" for c in fields])
