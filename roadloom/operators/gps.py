"""GPS normalisation and validation as table jobs with a reason column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions.gps import leading_numbers, matches_valid_pattern, to_decimal_degrees

ACCEPTED = "accepted"
REASON_NULL = "null"
REASON_FORMAT = "bad_format"
REASON_RANGE = "out_of_range"


def _in_range(lat, lon):
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def normalize_gps(df: DataFrame, column: str = "gps_coordinates") -> DataFrame:
    """Add ``latitude``, ``longitude``, ``gps_format`` and ``gps_reason``.

    Accepted rows have ``gps_reason = 'accepted'``; others keep NULL
    coordinates and say why.  Use ``split_rejects`` for two outputs.
    """
    pos = to_decimal_degrees(column)
    out = df.withColumn("__rl_pos", pos)
    lat, lon = F.col("__rl_pos.latitude"), F.col("__rl_pos.longitude")
    reason = (
        F.when(F.col(column).isNull(), F.lit(REASON_NULL))
        .when(F.col("__rl_pos.format").isNull(), F.lit(REASON_FORMAT))
        .when(~_in_range(lat, lon), F.lit(REASON_RANGE))
        .otherwise(F.lit(ACCEPTED))
    )
    ok = reason == F.lit(ACCEPTED)
    return out.select(
        *df.columns,
        F.when(ok, lat).alias("latitude"),
        F.when(ok, lon).alias("longitude"),
        F.col("__rl_pos.format").alias("gps_format"),
        reason.alias("gps_reason"),
    )


def validate_gps(df: DataFrame, column: str = "gps_coordinates") -> DataFrame:
    """The reference's cleaning rule with a reason column: not NULL, one of
    the three accepted notations, numeric range (not text comparison)."""
    lat, lon = leading_numbers(column)
    reason = (
        F.when(F.col(column).isNull(), F.lit(REASON_NULL))
        .when(~matches_valid_pattern(column), F.lit(REASON_FORMAT))
        .when(~F.coalesce(_in_range(lat, lon), F.lit(False)), F.lit(REASON_RANGE))
        .otherwise(F.lit(ACCEPTED))
    )
    return df.withColumn("gps_reason", reason)


def accepted_positions(df: DataFrame, column: str = "gps_coordinates") -> DataFrame:
    """``gps_reason`` of positions in any notation that `normalize_gps` or `validate_gps` accepts."""
    strict_reason = validate_gps(df, column).withColumnRenamed("gps_reason", "__rl_strict")
    both = normalize_gps(strict_reason, column)
    reason = F.when(F.col("__rl_strict") == F.lit(ACCEPTED), F.lit(ACCEPTED)).otherwise(F.col("gps_reason"))
    return once_per_row(both.select(*df.columns, reason.alias("gps_reason")), "gps_reason")


def once_per_row(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` fixed: what is built on it reads its value and does not work out its expression again.

    A generator of one value per row stands between: the optimizer copies no expression into a filter through it.
    """
    values = df.select(*[F.col(c) for c in df.columns if c != column], F.explode(F.array(column)).alias(column))
    return values.select(*df.columns)


def split_rejects(df: DataFrame, reason_col: str = "gps_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason) from one tagged frame.

    Both are lazy views of the same tagged plan; persist or write the tagged
    frame once when both outputs are materialised.
    """
    ok = F.col(reason_col) == F.lit(ACCEPTED)
    return df.where(ok).drop(reason_col), df.where(~ok)


def normalize_gps_split(df: DataFrame, column: str = "gps_coordinates") -> tuple[DataFrame, DataFrame]:
    """``normalize_gps`` as (accepted rows, rejected rows with ``gps_reason``)."""
    return split_rejects(normalize_gps(df, column))


def strict(df: DataFrame, reason_col: str = "gps_reason") -> DataFrame:
    """Fail the job on the first rejected row (the reference raised)."""
    return df.withColumn(
        reason_col,
        F.when(F.col(reason_col) == F.lit(ACCEPTED), F.col(reason_col)).otherwise(
            F.raise_error(F.concat(F.lit("Invalid coordinates format: "), F.col(reason_col)))
        ),
    )
