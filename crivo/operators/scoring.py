"""Predictions with their lineage."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions.credit import threshold_class
from crivo.functions.numeric import round_half_even

# Name of the class and probability columns of a prediction.
PREDICTION = "predicao_inadimplente"
PROBABILITY = "prob_inadimplencia"
_PROBABILITY_DIGITS = 4


def _lineage(model: str, version: int, scored_at: datetime.datetime | None) -> list[Column]:
    when = F.current_timestamp() if scored_at is None else F.lit(scored_at)
    return [
        F.lit(model).alias("modelo"),
        F.lit(str(version)).alias("versao_modelo"),
        when.cast("timestamp").alias("scored_at"),
    ]


def predictions(
    scored: DataFrame,
    model: str,
    version: int,
    class_column: str = "classe_modelo",
    scored_at: datetime.datetime | None = None,
) -> DataFrame:
    """Class per contract with model, version and one time for the query."""
    return scored.select(
        schema.KEY,
        F.col(class_column).cast("int").alias(PREDICTION),
        *_lineage(model, version, scored_at),
    )


def predictions_with_probability(
    scored: DataFrame,
    model: str,
    version: int,
    scored_at: datetime.datetime | None = None,
) -> DataFrame:
    """As ``predictions``, with the class from the 0.5 threshold and the
    probability. The class is decided before the probability is rounded."""
    return scored.select(
        schema.KEY,
        threshold_class(F.col("prob")).alias(PREDICTION),
        round_half_even(F.col("prob"), _PROBABILITY_DIGITS).alias(PROBABILITY),
        *_lineage(model, version, scored_at),
    )


def responses(scored: DataFrame, keep: list[str]) -> DataFrame:
    """What a point scoring answers: the class, and the probability to four
    places."""
    return scored.select(
        *keep,
        threshold_class(F.col("prob")).cast("bigint").alias("inadimplente"),
        round_half_even(F.col("prob"), _PROBABILITY_DIGITS).alias("prob"),
    )


def class_distribution(predicted: DataFrame) -> DataFrame:
    """Rows per predicted class, in class order."""
    return (
        predicted.groupBy(PREDICTION).agg(F.count(F.lit(1)).alias("n")).orderBy(PREDICTION)
    )


def first_contracts(df: DataFrame, k: int) -> DataFrame:
    """The k contracts with the smallest keys."""
    return df.orderBy(schema.KEY).limit(k)
