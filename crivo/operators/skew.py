"""Ranking and joining when one key may hold a large share of all rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo.sources.tables import staged

# A key with more rows than this is hot: one task should not hold its group.
HOT_ROWS = 1_000_000
# The hot keys travel to every task, so their number is bounded.
MOST_HOT_KEYS = 100_000
SALTS = 256
# Whole keys are ranked in blocks of 2^20 values, so one block of a unique key
# has at most that many rows.
KEY_BLOCK_BITS = 20


def hot_keys(df: DataFrame, key: str, limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None when there are none.

    Counting combines on the map side and reads one column. At most rows/limit
    keys can pass; when even that is more than ``MOST_HOT_KEYS`` the limit
    grows tenfold, so the result always fits a broadcast. Rows are counted once:
    keys that pass the first limit are staged if there are too many.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    while True:
        over = counts.where(F.col("n_rows") > limit)
        rows = over.limit(MOST_HOT_KEYS + 1).collect()
        if not rows:
            return None
        if len(rows) <= MOST_HOT_KEYS:
            return df.sparkSession.createDataFrame([(r[0],) for r in rows], df.select(key).schema)
        counts = staged(over, "hot_keys")
        limit *= 10


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    hot_key: str,
    spread: Column,
    hot: DataFrame | None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join, with the rows of hot keys spread over salts.

    ``hot_key`` is the column of ``on`` that ``hot`` lists values of, and
    ``spread`` an expression over the left columns that differs between rows of
    one key. Without hot keys this is the plain join.
    """
    if hot is None:
        return left.join(right, on, "left")
    marked = F.broadcast(hot.select(F.col(hot_key).alias("_hot")))
    is_hot, none = F.col("_hot").isNotNull(), F.lit(0).cast("bigint")
    every_salt = F.sequence(none, F.lit(salts - 1).cast("bigint"))

    def salted(side: DataFrame, salt: Column) -> DataFrame:
        return (
            side.join(marked, F.col(hot_key) == F.col("_hot"), "left")
            .withColumn("_salt", salt)
            .drop("_hot")
        )

    one = F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts).cast("bigint"))).otherwise(none)
    each = F.explode(F.when(is_hot, every_salt).otherwise(F.array(none)))
    return salted(left, one).join(salted(right, each), [*on, "_salt"], "left").drop("_salt")


def time_levels(ts: Column, unique_key: Column) -> list[Column]:
    """Levels of an order by (ts, unique_key), coarse to fine: day, second of
    the day, part of the second, block of the key. Each level has a bounded
    number of values below one value of the level above."""
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return [
        F.to_date(ts),
        second,
        F.date_part(F.lit("SECOND"), ts),
        *key_levels(unique_key),
    ]


def key_levels(unique_key: Column) -> list[Column]:
    """Levels of an order by a whole unique key: ranges of 2^40, then of 2^20."""
    return [
        F.shiftright(unique_key, 2 * KEY_BLOCK_BITS),
        F.shiftright(unique_key, KEY_BLOCK_BITS),
    ]


def position_in_group(
    df: DataFrame,
    group: str,
    order: list[str],
    levels: list[Column],
    name: str,
    hot: DataFrame | None,
) -> DataFrame:
    """Add the zero-based position of each row within its group.

    ``order`` must be a total order and ``levels`` must break the same order
    into steps, coarse to fine. Rows of a hot group are ranked within their
    finest level only; what comes before that level is counted from totals per
    level, so no task ever holds a hot group. Other groups take one window.
    """
    if hot is None:
        window = Window.partitionBy(group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)

    names = [f"_level{i}" for i in range(len(levels))]
    marked = F.broadcast(hot.select(F.col(group).alias("_group"), F.lit(True).alias("_hot")))
    is_hot = F.col("_hot").isNotNull()
    rows = df.join(marked, F.col(group).eqNullSafe(F.col("_group")), "left").select(
        *df.columns, *[F.when(is_hot, level).alias(n) for level, n in zip(levels, names)], "_hot"
    )
    offsets = _rows_before_level(rows.where(is_hot), group, names)

    block = Window.partitionBy(group, *names).orderBy(*order)
    inside = rows.repartition(group, *names).withColumn(
        "_inside", F.row_number().over(block).cast("bigint") - 1
    )
    same = F.lit(True)
    for n in [group, *names]:
        same = same & inside[n].eqNullSafe(offsets[n])
    return inside.join(offsets, same, "left").select(
        *[inside[c] for c in df.columns],
        (F.col("_inside") + F.coalesce(F.col("_before"), F.lit(0))).alias(name),
    )


def _rows_before_level(rows: DataFrame, group: str, names: list[str]) -> DataFrame:
    """Rows of the group that precede each finest level, as ``_before``."""
    finest = rows.groupBy(group, *names).agg(F.count(F.lit(1)).alias("_n"))
    result, counts = finest.withColumn("_before", F.lit(0).cast("bigint")), finest
    for depth in range(len(names), 0, -1):
        parent, here = [group, *names[: depth - 1]], names[depth - 1]
        earlier = Window.partitionBy(*parent).orderBy(here).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        step = counts.withColumn("_step", F.sum("_n").over(earlier) - F.col("_n"))
        step = step.select(*[F.col(c).alias(f"{c}_k") for c in [*parent, here]], "_step")
        same = F.lit(True)
        for c in [*parent, here]:
            same = same & F.col(c).eqNullSafe(F.col(f"{c}_k"))
        result = result.join(step, same, "inner").select(
            *finest.columns, (F.col("_before") + F.col("_step")).alias("_before")
        )
        counts = counts.groupBy(*parent).agg(F.sum("_n").alias("_n"))
    return result.drop("_n")
