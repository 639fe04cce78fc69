"""Row number and previous-row values inside ordered groups, whatever the size of a group: a segmented scan.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task.  If one key holds a third of the table,
that task is a third of the job.  Here the total order of (key, order) is cut into segments of about equal size, a
window numbers the rows of each (key, segment), and what a key has in earlier segments is carried in:

1. bounds are quantiles of a bounded sample of (key, order) rows (the rows of the smallest hashes); grouped by key they
   are at most one row per bound, which is broadcast;
2. a bound cuts its own key only, so a row's segment is its place among the bounds of its key: rows of other keys meet an
   equi-join that finds nothing, and are in segment 0 without any comparison;
3. the window runs per (key, segment): no task gets more of a key than lies between two bounds;
4. only keys that a bound cuts need more.  Per segment of theirs one summary row holds the count and the last row; a
   window over these rows (two per bound at most) gives what lies before each segment, and a join adds it.

It is one lazy plan for all sizes; no job runs while it is built.  The result equals the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEG = "__rl_bucket"

#: None uses the plain window; any number the segmented scan (kept for callers that named a limit).
DEFAULT_MAX_GROUP_ROWS = 5_000_000
#: Sampled rows per segment.
SAMPLE = 64


def nulls_last(order: list[str]) -> list[Column]:
    """Ascending order with NULLs last, as the source databases sort."""
    return [F.col(c).asc_nulls_last() for c in order]


def _place(order: list[str]) -> Column:
    """A row's place among the rows of its key as a value that compares, NULLs last."""
    return F.struct(*[x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}"))])


def _row(keys: list[str], order: list[str]) -> Column:
    """A row's place in the total order as a value that compares: (key, order)."""
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return F.struct(key.alias("k"), _place(order).alias("o"))


def segment_bounds(df: DataFrame, keys: list[str], order: list[str], segments: int, sample: int = SAMPLE) -> DataFrame:
    """One row with the array of the ``segments - 1`` bounds: quantiles of at most ``sample * segments`` rows.

    The sample is the rows whose hashes are smallest, so a rerun takes the same.  Each task keeps that many, none collects more.
    """
    rows = df.select(_row(keys, order).alias("r")).orderBy(F.xxhash64("r")).limit(sample * segments)
    sorted_ = rows.agg(F.sort_array(F.collect_list("r")).alias("s"))
    return sorted_.select(F.expr(f"transform(sequence(1, {segments - 1}), i -> get(s, cast(floor(size(s) * i / {segments}) AS INT)))").alias("b"))


def _stretches(bounds: DataFrame, keys: int) -> DataFrame:
    """Per key that bounds cut, its stretches between them: __rl_b<i> (the key), __rl_nth, __rl_low (excluded, NULL for
    none), __rl_high (included, NULL for none)."""
    cut = bounds.select(F.explode("b").alias("b")).where(F.col("b").isNotNull())
    own = cut.groupBy(F.col("b.k").alias("k")).agg(F.sort_array(F.collect_set("b.o")).alias("o"))
    return own.select(*[F.col("k").getField(f"k{i}").alias(f"__rl_b{i}") for i in range(keys)],
                      F.posexplode(F.expr("transform(sequence(0, size(o)), i -> struct(get(o, i - 1) AS low, get(o, i) AS high))"))).select(
        *[f"__rl_b{i}" for i in range(keys)], F.col("pos").alias("__rl_nth"), F.col("col.low").alias("__rl_low"), F.col("col.high").alias("__rl_high"))


def ordered_sequence(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    row_number: str | None = "row_number",
    lags: dict[str, str] | None = None,
    max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS,
    split: int | None = None,
) -> DataFrame:
    """Add ``row_number`` (1-based) and ``lags`` (``{out_col: source_col}``, value of the previous row) within
    ``keys`` ordered ascending by ``order``, NULLs last.

    ``order`` should end with a unique column, so that the order is total; rows that are alike in all of it are never cut
    apart.  ``split`` is the number of segments (default: the session's shuffle partitions).  ``max_group_rows=None`` uses
    the plain window.
    """
    lags = lags or {}
    segments = split or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def numbered(frame: DataFrame, *more: str) -> DataFrame:
        w = Window.partitionBy(*keys, *more).orderBy(*nulls_last(order))
        if row_number:
            frame = frame.withColumn(row_number, F.row_number().over(w).cast("long"))
        for name, src in lags.items():
            frame = frame.withColumn(name, F.lag(src, 1).over(w))
        return frame

    if not max_group_rows or segments < 2:
        return numbered(df)

    stretches = F.broadcast(_stretches(segment_bounds(df, keys, order, segments), len(keys)))
    place, low, high = _place(order), F.col("__rl_low"), F.col("__rl_high")
    within = (low.isNull() | (low < place)) & (high.isNull() | (place <= high))
    for i, k in enumerate(keys):
        within = within & F.col(k).eqNullSafe(F.col(f"__rl_b{i}"))

    def placed(how: str) -> DataFrame:
        return df.join(stretches, within, how).withColumn(_SEG, F.coalesce("__rl_nth", F.lit(0)))

    last = F.struct(place.alias("o"), *[F.col(s).alias(f"s{i}") for i, s in enumerate(lags.values())])
    summary = placed("inner").groupBy(*keys, _SEG).agg(F.count(F.lit(1)).alias("__rl_count"), F.max(last).alias("__rl_last"))
    before = Window.partitionBy(*keys).orderBy(_SEG)
    carry = summary.select(
        *[F.col(k).alias(f"__rl_k{i}") for i, k in enumerate(keys)], F.col(_SEG).alias("__rl_segment"),
        F.sum("__rl_count").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("__rl_offset"),
        F.lag("__rl_last", 1).over(before).alias("__rl_previous"))

    local = placed("left").select(*df.columns, _SEG)
    if lags:
        local = local.withColumn("__rl_nth", F.row_number().over(Window.partitionBy(*keys, _SEG).orderBy(*nulls_last(order))))
    local = numbered(local, _SEG)
    here = F.col(_SEG) == F.col("__rl_segment")
    for i, k in enumerate(keys):
        here = here & F.col(k).eqNullSafe(F.col(f"__rl_k{i}"))
    joined = local.join(F.broadcast(carry), here, "left")
    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col(row_number) + F.coalesce(F.col("__rl_offset"), F.lit(0))).alias(row_number))
    for i, name in enumerate(lags):  # only a key's first row in a segment has its previous row in another one
        out.append(F.when((F.col(_SEG) > 0) & (F.col("__rl_nth") == 1), F.col("__rl_previous").getField(f"s{i}")).otherwise(F.col(name)).alias(name))
    return joined.select(*out)
