"""Equi-joins, with care for keys that hold a large share of one side.

A plain shuffle join is left to adaptive execution, which picks a broadcast by
the measured size of a side and splits a skewed partition. That split does not
happen when the join feeds an aggregation on the join key, or when a side comes
out of one, because the aggregation relies on the key staying in one partition.
Two ways around it:

* `weights`: where only sums are wanted, shrink a side to one row per distinct
  combination with a count before joining, so a hot key arrives as few rows;
* `salted_join`: where every row is wanted, spread the hot keys by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millwright.workspace import stage_counted

WEIGHT = "_weight"

# A key above this many rows is spread over several tasks.
HOT_KEY_ROWS = 2_000_000
# Rows to see of a key at that limit when looking for hot keys.
SAMPLE_PER_KEY = 50
# The list of hot keys is broadcast up to this many entries, else joined by shuffle.
BROADCAST_KEYS = 100_000

_SPREAD = "_spread"
_SALTS, _SALT, _MATCHED = "_salts", "_salt", "_matched"


def not_broadcast(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the data, joined by shuffle.

    Sizes are estimated from files, and a few columns of well packed ones may hold many times
    the rows that the driver can take.
    """
    return side.hint("merge")


def weights(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of `columns` with the number of rows behind each."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(WEIGHT))


def weights_by_key(
    df: DataFrame, key: str, *columns: str, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """`weights` of columns that include the join key, in one shuffle where no key is hot.

    Rows go to their key's partition first and are combined there, which the
    join then reuses. Where some key holds very many rows they are combined by
    all columns first, so that the key arrives as few rows, at the price of a
    second shuffle. `df` should be a stored table.
    """
    if hot_keys(df, key, hot_key_rows) is None:
        df = df.select(*columns).repartition(key)
    return weights(df, *columns)


def weights_if_hot(
    df: DataFrame, key: str, *columns: str, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """`weights` if some key holds very many rows, else the rows themselves with weight 1.

    For a side whose key is nearly unique, combining would only add a shuffle.
    The other side of the join must have one row per key.
    """
    if hot_keys(df, key, hot_key_rows) is None:
        return df.select(*columns).withColumn(WEIGHT, F.lit(1))
    return weights(df, *columns)


def hot_keys(df: DataFrame, key: str, hot_key_rows: int) -> tuple[DataFrame, int] | None:
    """Keys with more than about `hot_key_rows` rows, with a number of shares each, and their count.

    Estimated from a sample of the key column, so nothing but the sample is
    shuffled. It may steer how rows are spread, never which rows there are.
    `df` should be a stored table or a projection of one, since it is read again.
    """
    if df.count() <= hot_key_rows:
        return None
    fraction = min(1.0, SAMPLE_PER_KEY / hot_key_rows)
    estimate = F.col("count") / F.lit(fraction)
    found, n_found = stage_counted(
        df.select(key)
        .where(F.col(key).isNotNull())
        .sample(fraction, seed=1)
        .groupBy(key)
        .count()
        .where(estimate > hot_key_rows)
        .select(key, F.ceil(estimate / F.lit(hot_key_rows)).cast("int").alias(_SALTS))
    )
    return (found, n_found) if n_found else None


def salted_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: list[str],
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Inner join on `key` where some keys of `many` may hold very many rows.

    Rows of hot keys are split into numbered shares by a hash of `spread_by`, and
    the matching rows of `one` are repeated once per share. Without hot keys this
    is a plain join.
    """
    found = hot_keys(many, key, hot_key_rows)
    if found is None:
        return many.join(not_broadcast(one), key, "inner")
    hot, n_hot = found
    if n_hot <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    share = F.pmod(F.xxhash64(*spread_by), salts).cast("int")
    many_salted = many.join(hot, key, "left").withColumn(_SALT, share).drop(_SALTS)
    one_salted = (
        one.join(hot, key, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop(_SALTS)
    )
    return many_salted.join(not_broadcast(one_salted), [key, _SALT], "inner").drop(_SALT)


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: list[str], *, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Left outer join on `key` where some keys of the right side may hold very many rows.

    Adaptive execution can split the left side of an outer join but not the right.
    Rows of the right side's hot keys are split into numbered shares by a hash of
    `spread_by`, and the left rows of such a key are repeated once per share. In
    shares without a right row a repeated left row finds nothing and goes: a hot
    key was seen on the right, so every left row of it has a match in some
    share, and rows of all other keys stay once, matched or not. `right` should be
    a stored table or a projection of one.
    """
    found = hot_keys(right, key, hot_key_rows)
    if found is None:
        return left.join(not_broadcast(right), key, "left")
    hot, n_hot = found
    if n_hot <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    share = F.pmod(F.xxhash64(*spread_by), salts).cast("int")
    right_salted = right.join(hot, key, "left").withColumn(_SALT, share).drop(_SALTS).withColumn(_MATCHED, F.lit(True))
    left_salted = left.join(hot, key, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    joined = left_salted.join(not_broadcast(right_salted), [key, _SALT], "left")
    return joined.where(F.col(_SALTS).isNull() | F.col(_MATCHED).isNotNull()).drop(_SALT, _SALTS, _MATCHED)


def inspections_with_production(inspections: DataFrame, production: DataFrame) -> DataFrame:
    """Inspections inner-joined to their batch.

    Both tables carry an ingestion time; only the one of the inspection is kept.
    """
    shared = (set(inspections.columns) & set(production.columns)) - {"batch_id"}
    return inspections.join(production.drop(*shared), "batch_id", "inner")


def quality_with_product(
    quality: DataFrame, production: DataFrame, products: DataFrame, *, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Metric rows with product id and category, one per production row of the batch; rows without a match keep NULLs.

    A batch with very many production rows is spread over several tasks, by a
    hash of whole rows; the hash is pruned where no batch is hot.
    """
    made = production.select("batch_id", "product_id", F.xxhash64(*production.columns).alias(_SPREAD))
    joined = salted_left_join(quality, made, "batch_id", [_SPREAD], hot_key_rows=hot_key_rows).drop(_SPREAD)
    return joined.join(products.select("product_id", "product_category"), "product_id", "left")


def material_with_quality(
    materials: DataFrame, quality: DataFrame, *, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """One row per material row and metric row of the same batch."""
    left = materials.select("batch_id", "material_id", "supplier_id", "received_date")
    right = quality.select("batch_id", F.col("defect_rate").cast("double").alias("defect_rate"))
    spread_by = ["material_id", "supplier_id", "received_date"]
    joined = salted_join(left, right, "batch_id", spread_by, hot_key_rows=hot_key_rows)
    return joined.select(*left.columns, "defect_rate")
