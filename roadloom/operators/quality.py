"""Data-quality reports: null counts, row-count sanity, stated-vs-actual totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: total rows, rows without any NULL, and NULLs per column.

    A single aggregation pass (P15 and the row-count sanity check P16:
    ``clean_rows <= total_rows`` with ``clean_rows`` what ``na.drop()`` keeps).
    """
    cols = columns or df.columns
    any_null = None
    for c in cols:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~any_null).alias("clean_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
    )


def null_report_of_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
) -> DataFrame:
    """``null_report(left.join(right, on, how))`` without moving the data.

    Each side is first reduced to its join keys plus one boolean per column
    ("is NULL"), so the join shuffles keys and flags, never wide values such
    as document texts.  After a left join an unmatched right row counts as
    NULL in every right column, as in the joined table.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    lcols = [c for c in left.columns if c not in on]
    rcols = [c for c in right.columns if c not in on]
    lf = left.select(*on, *[F.col(c).isNull().alias(f"__rl_l_{c}") for c in lcols])
    rf = right.select(*on, F.lit(True).alias("__rl_hit"), *[F.col(c).isNull().alias(f"__rl_r_{c}") for c in rcols])
    j = lf.join(rf, on, how)
    flags = {c: F.col(c).isNull() for c in on}
    flags.update({c: F.col(f"__rl_l_{c}") for c in lcols})
    flags.update({c: F.coalesce(F.col(f"__rl_r_{c}"), F.lit(True)) for c in rcols})
    any_null = None
    for f in flags.values():
        any_null = f if any_null is None else (any_null | f)
    order = left.columns + rcols
    return j.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~any_null).alias("clean_rows"),
        *[F.count_if(flags[c]).alias(f"null_{c}") for c in order],
    )


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without NULL in ``subset`` (all columns when omitted)."""
    return df.na.drop("any", subset=subset)


def metadata_reconcile(
    df: DataFrame,
    *,
    group_cols: list[str],
    stated: str,
    actual,
    count_name: str = "n_rows",
) -> DataFrame:
    """Per group: row count, stated total, recomputed total and whether they agree."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias(count_name),
        F.sum(stated).alias(f"stated_{stated}"),
        F.sum(actual).alias(f"actual_{stated}"),
    ).withColumn("consistent", F.col(f"stated_{stated}") == F.col(f"actual_{stated}"))
