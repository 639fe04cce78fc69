"""Vehicle warranty status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions.columns import age_in_years, days_between, lit_date
from roadloom.session import holding, worked_out_once

# Fixed labels of the reference's warranty report.
OUT_OF_WARRANTY = "out of warranty"
IN_WARRANTY = "in warranty"
NOT_AVAILABLE = "N/A"


def merge_warranty(stored: DataFrame, delta: DataFrame, as_of: str | dt.date, *, ids: list[str] | None = None,
                   order: bool = False) -> DataFrame:
    """``stored`` rows (ids, purchase_date, warranty_expiration_date) with those of ``delta`` put in by id, as a report.

    Status, age and the totals per status are worked out again over all rows at ``as_of``, so totals never mix a
    window with the history.
    """
    ids = ids or ["motorcycle_id"]
    cond = None
    for i, k in enumerate(ids):
        c = F.col(k).eqNullSafe(F.col(f"__rl_k{i}"))
        cond = c if cond is None else cond & c
    side = delta.select(*[F.col(k).alias(f"__rl_k{i}") for i, k in enumerate(ids)])
    base = [*ids, "purchase_date", "warranty_expiration_date"]
    rows = stored.join(side, cond, "left_anti").select(*base).unionByName(delta.select(*base))
    return warranty_status(rows, as_of, ids=ids, expiry_date="warranty_expiration_date", order=order)


def warranty_status(
    df: DataFrame,
    as_of: str | dt.date,
    *,
    ids: list[str] | None = None,
    purchase_date: str = "purchase_date",
    expiry_date: str = "warranty_expiration_date",
    order: bool = True,
) -> DataFrame:
    """Warranty duration, age in years, status and rows per status.

    ``as_of`` replaces the wall clock so a run is reproducible.  Status
    compares days with days: out of warranty iff ``as_of`` is after the expiry
    date; any missing date gives ``N/A``.  The per-status count is a grouped
    count (at most three rows, broadcast) joined back, not a window: a window
    partitioned by three values would put the whole table in three tasks.  The
    rows are worked out once, for the report, its counts and its order.
    """
    ids = ids or ["motorcycle_id"]
    today = lit_date(as_of)
    pur = F.col(purchase_date).cast("date")
    exp = F.col(expiry_date).cast("date")
    base = df.select(
        *ids,
        pur.alias("purchase_date"),
        exp.alias("warranty_expiration_date"),
    ).withColumns(
        {
            "warranty_duration": days_between("purchase_date", "warranty_expiration_date"),
            "age_in_years": age_in_years("purchase_date", today),
            "warranty_status": F.when(
                F.col("purchase_date").isNull() | F.col("warranty_expiration_date").isNull(),
                F.lit(NOT_AVAILABLE),
            )
            .when(today > F.col("warranty_expiration_date"), F.lit(OUT_OF_WARRANTY))
            .otherwise(F.lit(IN_WARRANTY)),
        }
    )
    base = worked_out_once(base)
    counts = base.groupBy("warranty_status").agg(F.count(F.lit(1)).alias("total_by_warranty_status"))
    out = base.join(F.broadcast(counts), "warranty_status", "inner")
    if order:
        out = out.orderBy(F.desc("age_in_years"), *[F.col(i) for i in ids])
    return holding(out.select(*ids, "purchase_date", "warranty_expiration_date", "warranty_duration",
                              "age_in_years", "warranty_status", "total_by_warranty_status"), base)
