"""Data tests. Each returns the failing rows or groups; a report counts them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL aside."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
    )


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the accepted ones, with their row counts."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column).agg(F.count("*").alias("n_rows"))
    )


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign key values without a parent, with their row counts.

    Counted before the join, so a frequent orphan is one row in it.
    """
    used = (
        child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("fk_value"))
        .agg(F.count("*").alias("n_rows"))
    )
    return used.join(parent.select(F.col(pk).alias("fk_value")), "fk_value", "left_anti")


@dataclass
class Check:
    """One named test: its model, column, kind and failing rows."""

    model: str
    column: str
    kind: str
    failing: DataFrame


def column_report(model: str, df: DataFrame, columns: dict[str, tuple[str, ...]]) -> DataFrame:
    """The report rows of a model's not_null and unique tests, from one pass over it.

    Rows are grouped by the first unique column with the null counts of all others, then summed;
    a further unique column, which no model here has, would be counted by itself.
    """
    single = [c for c, kinds in columns.items() if "unique" in kinds]
    nulls = [c for c, kinds in columns.items() if "not_null" in kinds]
    by = [F.col(single[0]).alias("_key")] if single else []
    per = df.groupBy(*by).agg(F.count("*").alias("_n"), *[
        F.sum(F.col(c).isNull().cast("long")).alias(f"_null_{c}") for c in nulls])
    counts = [F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"not_null {c}") for c in nulls]
    if single:
        twice = F.col("_key").isNotNull() & (F.col("_n") > 1)
        counts.append(F.coalesce(F.sum(twice.cast("long")), F.lit(0)).alias(f"unique {single[0]}"))
    rows = per.agg(*counts)
    named = F.array(*[F.struct(F.lit(c.split(" ")[1]).alias("column_name"), F.lit(c.split(" ")[0]).alias("test"),
                               F.col(f"`{c}`").alias("n_failures")) for c in rows.columns])
    out = rows.select(F.lit(model).alias("model"), F.inline(named)).withColumn("passed", F.col("n_failures") == 0)
    others = [Check(model, c, "unique", unique(df, c)) for c in single[1:]]
    return out.unionByName(dq_report(others)) if others else out


def column_checks(model: str, df: DataFrame, columns: dict[str, tuple[str, ...]]) -> list[Check]:
    """not_null and unique tests of one model: {"id": ("not_null", "unique")}."""
    tests = {"not_null": not_null, "unique": unique}
    return [Check(model, c, kind, tests[kind](df, c)) for c, kinds in columns.items() for kind in kinds]


def dq_report(checks: list[Check | DataFrame]) -> DataFrame:
    """One row per test: failures and a pass flag. Reports that are made already are taken as they are."""
    out = None
    for c in checks:
        if isinstance(c, DataFrame):
            out = c if out is None else out.unionByName(c)
            continue
        one = c.failing.agg(F.count("*").alias("n_failures")).select(
            F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("test"), "n_failures", (F.col("n_failures") == 0).alias("passed"),
        )
        out = one if out is None else out.unionByName(one)
    return out
