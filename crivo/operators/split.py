"""Stratified train/test split that any later job reproduces from the key.

The test rows of a class are the ceil(share * n) rows with the smallest
(hash, key). Ranking a class would put it into one task, so the cut is found
digit by digit: count the rows per leading hash digit, see in which digit the
cut falls, and go on inside that digit. Each step returns a bounded table, and
with the cut known the split itself is a comparison per row.

The input is read three times to find the cuts and once to apply them, key and
label only: give it a table, not an expensive query.
"""

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions.credit import known_class
from crivo.functions.hashing import HASH_BITS, hash32

TEST_SHARE = Fraction(1, 5)
SPLIT_SEED = 42
_DIGIT_BITS = 16


def split_cuts(
    df: DataFrame,
    key: str = schema.KEY,
    label: str = schema.LABEL,
    share: Fraction = TEST_SHARE,
    seed: int = SPLIT_SEED,
    classes=schema.CLASSES,
) -> DataFrame:
    """One row per class: the largest (hash, key) that is still test, and the
    class sizes. ``classes`` bounds the table."""
    rows = _hashed(df, key, known_class(F.col(label), classes), seed)

    first_digit = _count(rows, F.shiftright("_hash", HASH_BITS - _DIGIT_BITS))
    size = Window.partitionBy("_label")
    wanted = first_digit.withColumn("_n_class", F.sum("_n").over(size)).withColumn(
        "_wanted", _ceil_share("_n_class", share)
    )
    cut = F.broadcast(_digit_of_cut(wanted, "_high"))

    inside = rows.join(cut, "_label").where(
        F.shiftright("_hash", HASH_BITS - _DIGIT_BITS) == F.col("_high")
    )
    second_digit = _count(
        inside,
        F.col("_hash").bitwiseAND(F.lit(2**_DIGIT_BITS - 1)),
        "_high",
        "_n_class",
        "_wanted",
    )
    cut = F.broadcast(
        _digit_of_cut(second_digit, "_low", "_high").withColumn(
            "_cut_hash", F.col("_high") * F.lit(2**_DIGIT_BITS) + F.col("_low")
        )
    )

    # Rows that share the whole hash: one in 2^32.
    equal = rows.join(cut, "_label").where(F.col("_hash") == F.col("_cut_hash"))
    in_key_order = Window.partitionBy("_label").orderBy("_key")
    return (
        equal.withColumn("_position", F.row_number().over(in_key_order))
        .where(F.col("_position") == F.col("_wanted"))
        .select(
            F.col("_label").alias(label),
            F.col("_cut_hash").alias("cut_hash"),
            F.col("_key").alias("cut_key"),
            F.col("_n_class").alias("n_class"),
        )
    )


def mark_test_rows(
    df: DataFrame,
    cuts: DataFrame,
    key: str = schema.KEY,
    label: str = schema.LABEL,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add ``is_test``. The cuts have one row per class, so no row of ``df``
    moves."""
    row_hash = hash32(f"split|{seed}", F.col(key))
    is_test = (row_hash < F.col("cut_hash")) | (
        (row_hash == F.col("cut_hash")) & (F.col(key) <= F.col("cut_key"))
    )
    return (
        df.join(F.broadcast(cuts), label, "left")
        .withColumn("is_test", F.coalesce(is_test, F.lit(False)))
        .select(*df.columns, "is_test")
    )


def stratified_split(
    df: DataFrame,
    key: str = schema.KEY,
    label: str = schema.LABEL,
    share: Fraction = TEST_SHARE,
    seed: int = SPLIT_SEED,
    classes=schema.CLASSES,
) -> DataFrame:
    """Add ``is_test`` to every row."""
    cuts = split_cuts(df, key, label, share, seed, classes)
    return mark_test_rows(df, cuts, key, label, seed)


def split_report(split: DataFrame, n_features: int, label: str = schema.LABEL) -> DataFrame:
    """Rows and positives on either side of the split."""
    return (
        split.groupBy("is_test")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(label).alias("n_positive"))
        .withColumn("n_features", F.lit(n_features))
    )


def _hashed(df: DataFrame, key: str, label: Column, seed: int) -> DataFrame:
    # Without a key a row has no place in the order, and would count as test
    # without ever being it.
    no_key = F.raise_error(F.lit(f"a row to split has no {key}"))
    checked = F.when(F.col(key).isNull(), no_key.cast(df.schema[key].dataType)).otherwise(F.col(key))
    return df.select(
        F.col(key).alias("_key"),
        label.alias("_label"),
        hash32(f"split|{seed}", checked).alias("_hash"),
    )


def _count(rows: DataFrame, digit, *carried: str) -> DataFrame:
    return rows.groupBy("_label", *carried, digit.alias("_digit")).agg(
        F.count(F.lit(1)).alias("_n")
    )


def _ceil_share(n: str, share: Fraction):
    """ceil(share * n) in whole numbers."""
    top, bottom = share.numerator, share.denominator
    return F.expr(f"({n} * {top} + {bottom - 1}) div {bottom}")


def _digit_of_cut(counts: DataFrame, name: str, *carried: str) -> DataFrame:
    """The digit in which the wanted row falls, and how many rows are wanted
    inside it. The window holds at most 2^16 digits per class."""
    up_to = Window.partitionBy("_label").orderBy("_digit").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = F.sum("_n").over(up_to)
    return (
        counts.withColumn("_reached", reached)
        .where(
            (F.col("_reached") >= F.col("_wanted"))
            & (F.col("_reached") - F.col("_n") < F.col("_wanted"))
        )
        .select(
            "_label",
            *carried,
            F.col("_digit").alias(name),
            "_n_class",
            (F.col("_wanted") - F.col("_reached") + F.col("_n")).alias("_wanted"),
        )
    )
