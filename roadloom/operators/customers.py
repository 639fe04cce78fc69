"""Customers: user-profile joins, deleted-user flag, unions, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions.columns import total


def user_profiles_join(
    users: DataFrame,
    profiles: DataFrame,
    *,
    user_key: str = "id",
    profile_key: str = "user_id",
    columns: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Inner equi-join of users and profiles, then select + rename.

    ``columns`` maps output name -> input column (either side).  Without it
    all columns are kept and the user key is renamed ``user_id``.
    """
    u = users.alias("u")
    p = profiles.alias("p")
    joined = u.join(p, F.col(f"u.{user_key}") == F.col(f"p.{profile_key}"), "inner")
    if columns is None:
        keep = [F.col(f"u.{user_key}").alias("user_id")]
        keep += [F.col(f"u.{c}") for c in users.columns if c != user_key]
        keep += [F.col(f"p.{c}") for c in profiles.columns if c != profile_key]
        return joined.select(*keep)
    return joined.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()])


def flag_existing(
    df: DataFrame,
    keys: DataFrame,
    *,
    key: str = "user_id",
    keys_key: str | None = None,
    flag: str = "deleted_user",
) -> DataFrame:
    """Add a boolean ``flag``: is the row's key present in ``keys``?

    Distinct keys (partial aggregation) then a left outer join; AQE picks a
    broadcast when the key set is small and a shuffle join otherwise.
    """
    kk = keys_key or key
    present = keys.select(F.col(kk).alias("__rl_key")).distinct().withColumn("__rl_hit", F.lit(True))
    out = df.join(present, df[key] == present["__rl_key"], "left")  # NULL keys never match
    return out.withColumn(flag, F.coalesce(F.col("__rl_hit"), F.lit(False))).drop("__rl_key", "__rl_hit")


def customers_full(
    users: DataFrame,
    profiles: DataFrame,
    deleted_users: DataFrame,
    deleted_profiles: DataFrame,
    *,
    user_key: str = "id",
    profile_key: str = "user_id",
    identity_key: str | None = None,
    out_key: str = "user_id",
    columns: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Live and deleted customers, each joined to its profile, appended, and
    flagged ``deleted_user`` by an existence test against the deleted users.

    ``identity_key`` is the user column that identifies a user (defaults to
    the join key); ``out_key`` is its name in the output.
    """
    live = user_profiles_join(users, profiles, user_key=user_key, profile_key=profile_key, columns=columns)
    gone = user_profiles_join(
        deleted_users, deleted_profiles, user_key=user_key, profile_key=profile_key, columns=columns
    )
    return flag_existing(live.unionByName(gone), deleted_users, key=out_key, keys_key=identity_key or user_key)


def customer_activity_union(
    rollup_rows: DataFrame,
    net_rows: DataFrame,
    *,
    deleted_users: DataFrame | None = None,
    key: str = "user_id",
    deleted_key: str | None = None,
) -> DataFrame:
    """Rollup rows and net-purchase rows in one table (missing columns NULL),
    optionally flagged with ``deleted_user``."""
    out = rollup_rows.unionByName(net_rows, allowMissingColumns=True)
    if deleted_users is not None:
        out = flag_existing(out, deleted_users, key=key, keys_key=deleted_key or key)
    return out


def customer_enrichment(
    customers: DataFrame,
    purchases: DataFrame,
    *,
    customer_key: str = "user_id",
    purchase_key: str = "user_id",
    amount: str = "amount",
    purchased_at: str = "purchase_date",
    float_scale: int | None = None,
) -> DataFrame:
    """Customers with ``lifetime_value`` and ``last_purchase_date``.

    Purchases are aggregated per customer first (map-side partial
    aggregation), so the join sees one row per customer instead of every
    purchase.  Customers without purchases keep NULLs (left join).
    """
    per_user = purchases.groupBy(F.col(purchase_key).alias("__rl_pk")).agg(
        total(amount, float_scale).alias("lifetime_value"),
        F.max(purchased_at).alias("last_purchase_date"),
        F.count(F.lit(1)).alias("purchase_count"),
    )
    out = customers.join(per_user, customers[customer_key] == per_user["__rl_pk"], "left").drop("__rl_pk")
    return out.withColumn("purchase_count", F.coalesce(F.col("purchase_count"), F.lit(0).cast("long")))
