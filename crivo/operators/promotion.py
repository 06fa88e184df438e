"""Champion against challenger on the holdout, and what follows from it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo import schema
from crivo.operators.metrics import auc
from crivo.operators.registry import Registry

CHAMPION = "champion"
CHALLENGER = "challenger"


def compare(
    stacked: DataFrame, label: str = schema.LABEL, by: tuple[str, ...] = ("alias",)
) -> DataFrame:
    """AUC per alias, from one row per (row, alias)."""
    return auc(stacked, label, "prob", by)


def decide(compared: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One decision per comparison.

    The challenger must be strictly better; a tie keeps the champion, and so
    does an AUC that is not defined or a missing challenger.
    """

    def of(alias):
        return F.max(F.when(F.col("alias") == alias, F.col("auc")))

    present = F.max(F.when(F.col("alias") == CHALLENGER, F.lit(1)))
    sides = compared.groupBy(*by).agg(
        of(CHAMPION).alias("auc_champion"),
        of(CHALLENGER).alias("auc_challenger"),
        present.alias("_present"),
    )
    champion, challenger = F.col("auc_champion"), F.col("auc_challenger")
    decision = (
        F.when(F.col("_present").isNull(), "no_challenger")
        .when(champion.isNull() | challenger.isNull(), "undefined")
        .when(challenger > champion, "promoted")
        .otherwise("kept")
    )
    return sides.select(*by, champion, challenger, decision.alias("decision"))


def apply_decision(registry: Registry, decision: str) -> None:
    """Move the champion alias to the challenger's version and drop the
    challenger alias, if that is the decision."""
    if decision != "promoted":
        return
    winner = registry.version_of(CHALLENGER)
    registry.set_alias(CHAMPION, winner)
    registry.delete_alias(CHALLENGER)
