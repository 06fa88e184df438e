"""Exact ranking and classification metrics over any number of rows."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions.credit import threshold_class
from crivo.sources.tables import staged

# Counts fit a bigint, counts of pairs do not.
_COUNT = "decimal(19,0)"
_PAIRS = "decimal(38,0)"


def auc(
    df: DataFrame, label: str = schema.LABEL, score: str = "prob", by: tuple[str, ...] = ()
) -> DataFrame:
    """Area under the ROC curve per group, ties counted half; NULL when a group
    has one class only. Scores must lie in [0, 1].

    Rows with equal scores become one row. These are sorted by ranges, however
    close the scores lie, and written once. A positive then wins against the
    negatives below it in its range, which a window over that range counts, and
    against all negatives of the ranges before, which a window over one row per
    range counts. A range is a bounded share of the scores, so no task holds a
    whole group.
    """
    counts = _pair_counts(df, label, score, by)
    return counts.select(*by, "n_positive", "n_negative", "auc")


def confusion_counts(
    df: DataFrame, label: str = schema.LABEL, predicted: str = "predicao", by: tuple[str, ...] = ()
) -> DataFrame:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(y & ~p).alias("fn"),
    )


def classification_metrics(
    df: DataFrame, label: str = schema.LABEL, predicted: str = "predicao", by: tuple[str, ...] = ()
) -> DataFrame:
    """Accuracy and F1 of class 1; F1 is 0 when class 1 neither occurs nor is
    predicted."""
    return confusion_counts(df, label, predicted, by).select(*by, *_accuracy_and_f1())


def evaluate(
    df: DataFrame, by: str, label: str = schema.LABEL, score: str = "prob"
) -> DataFrame:
    """AUC, accuracy and F1 at the 0.5 threshold, one row per model named in
    column ``by``. All three come from the same counts per score, so the rows
    are scored once."""
    counts = _pair_counts(df, label, score, (by,))
    return counts.select(by, *_accuracy_and_f1(), "auc")


def default_rate(df: DataFrame, label: str = schema.LABEL) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(label).alias("n_default"),
        F.avg(F.col(label).cast("double")).alias("default_rate"),
    )


def stack_scores(df: DataFrame, scores: dict[str, str], keep: list[str]) -> DataFrame:
    """One row per (row, model): several score columns evaluated in one scan."""
    pairs = F.array(
        *[F.struct(F.lit(a).alias("alias"), F.col(c).alias("prob")) for a, c in scores.items()]
    )
    return df.select(*keep, F.explode(pairs).alias("_pair")).select(
        *keep, "_pair.alias", "_pair.prob"
    )


def _accuracy_and_f1() -> list[Column]:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    accuracy = F.try_divide((tp + tn).cast("double"), (tp + fp + tn + fn).cast("double"))
    f1 = F.try_divide(F.lit(2.0) * tp, (F.lit(2) * tp + fp + fn).cast("double"))
    return [accuracy.alias("accuracy"), F.coalesce(f1, F.lit(0.0)).alias("f1")]


def _pair_counts(df: DataFrame, label: str, score: str, by: tuple[str, ...]) -> DataFrame:
    """Class sizes, confusion counts at the threshold and AUC, per group."""
    value, y = F.col(score), F.col(label)
    in_range = value.between(0.0, 1.0) & ~F.isnan(value) & y.isin(*schema.CLASSES)
    checked = F.when(F.coalesce(in_range, F.lit(False)), value + F.lit(0.0)).otherwise(
        F.raise_error(F.lit("AUC needs a score in [0, 1] and a label on every row")).cast("double")
    )
    called = threshold_class(F.col("_score")).cast("bigint")

    counts = (
        df.select(*by, checked.alias("_score"), y.alias("_y"))
        .groupBy(*by, "_score")
        .agg(
            F.count_if(F.col("_y") == 1).alias("_pos"),
            F.count_if(F.col("_y") == 0).alias("_neg"),
        )
        .withColumns(
            {
                # Twice the won pairs, so that half a point for a tie stays whole.
                "_won": _times(F.col("_pos"), F.col("_neg")),
                "_tp": F.col("_pos") * called,
                "_fp": F.col("_neg") * called,
            }
        )
    )
    keys = [*by, "_score"]
    ranges = staged(
        counts.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "score_ranges"
    )
    totals = ranges.groupBy(*by, "_part").agg(F.sum("_neg").alias("_below_part"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_below_part", F.coalesce(F.sum("_below_part").over(before), F.lit(0)))
    inside = Window.partitionBy(*by, "_part").orderBy("_score").rowsBetween(
        Window.unboundedPreceding, -1
    )
    below = F.col("_below_part") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    # As many rows as there are groups and ranges.
    totals = totals.select(*[F.col(c).alias(f"_of{c}") for c in (*by, "_part")], "_below_part")
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in (*by, "_part")]
    placed = ranges.join(F.broadcast(totals), reduce(and_, same))
    won = F.col("_won") + _times(F.col("_pos"), F.lit(2) * below)
    counts = _sum_counts(placed.withColumn("_won", won), list(by))

    pairs = F.lit(2.0) * F.col("_pos").cast("double") * F.col("_neg").cast("double")
    return counts.select(
        *by,
        F.col("_pos").alias("n_positive"),
        F.col("_neg").alias("n_negative"),
        F.col("_tp").alias("tp"),
        F.col("_fp").alias("fp"),
        (F.col("_neg") - F.col("_fp")).alias("tn"),
        (F.col("_pos") - F.col("_tp")).alias("fn"),
        F.when(pairs > 0, F.col("_won").cast("double") / pairs).alias("auc"),
    )


def _sum_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("_pos", "_neg", "_tp", "_fp")]
    return counts.groupBy(*keys).agg(*sums, F.sum("_won").cast(_PAIRS).alias("_won"))


def _times(a: Column, b: Column) -> Column:
    return (a.cast(_COUNT) * b.cast(_COUNT)).cast(_PAIRS)
