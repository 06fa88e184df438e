"""Loan arithmetic and default risk, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from crivo.functions.numeric import clip

# Weights of the latent risk score.
RISK_INTERCEPT = -3.0
RISK_COMMITMENT = 2.4
RISK_UTILISATION = 1.8
RISK_CREDIT_SCORE = -0.004
RISK_CREDIT_SCORE_CENTRE = 640
RISK_TERM_YEARS = 0.15
RISK_PREVIOUS_CONTRACTS = -0.20
COMMITMENT_LIMIT = 3.0
CLASS_THRESHOLD = 0.5

TINY_RATE = 1e-6


def instalment(principal: Column, monthly_rate: Column, months: Column) -> Column:
    """Level instalment of an annuity; a zero rate spreads the principal.

    ``1 + rate`` loses the digits of a tiny rate, so those take the form that
    never adds it to one.
    """
    annuity = F.lit(1.0) - F.pow(F.lit(1.0) + monthly_rate, -months)
    tiny = F.abs(monthly_rate) < F.lit(TINY_RATE)
    annuity = F.when(tiny, -F.expm1(-months * F.log1p(monthly_rate))).otherwise(annuity)
    return F.when(monthly_rate == F.lit(0.0), principal / months).otherwise(
        F.try_divide(principal * monthly_rate, annuity)
    )


def commitment_ratio(monthly_payment: Column, annual_income: Column) -> Column:
    """Share of the monthly income the payment takes, limited to [0, 3]. NULL
    when there is no income."""
    monthly_income = annual_income / F.lit(12.0)
    return clip(F.try_divide(monthly_payment, monthly_income), 0.0, COMMITMENT_LIMIT)


def risk_score(
    commitment: Column,
    utilisation: Column,
    credit_score: Column,
    months: Column,
    previous: Column,
    noise: Column | None = None,
    utilisation_weight: float = RISK_UTILISATION,
) -> Column:
    score = (
        F.lit(RISK_INTERCEPT)
        + F.lit(RISK_COMMITMENT) * commitment
        + F.lit(utilisation_weight) * utilisation
        + F.lit(RISK_CREDIT_SCORE) * (credit_score - F.lit(RISK_CREDIT_SCORE_CENTRE))
        + F.lit(RISK_TERM_YEARS) * (months / F.lit(12.0))
        + F.lit(RISK_PREVIOUS_CONTRACTS) * previous
    )
    return score if noise is None else score + noise


def bernoulli(u: Column, probability: Column) -> Column:
    """1 when the draw falls below the probability, else 0."""
    return (u < probability).cast("bigint")


def threshold_class(probability: Column, threshold: float = CLASS_THRESHOLD) -> Column:
    """Class 1 from the threshold on, the threshold included."""
    return (probability >= F.lit(threshold)).cast("int")


def known_class(label: Column, classes) -> Column:
    """The label itself; one outside the classes raises, so that no row is
    left out unseen and one row per class is all there is to broadcast."""
    unknown = F.raise_error(
        F.concat(F.lit("label outside the classes: "), F.coalesce(label.cast("string"), F.lit("NULL")))
    )
    return F.when(label.isin(*classes), label).otherwise(unknown.cast("bigint"))
