"""Synthetic contracts, drawn from the seed and the key of each row."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions import credit
from crivo.functions import distributions as dist
from crivo.functions.hashing import uniforms
from crivo.functions.numeric import clip, logistic, round_half_even

SEED = 42

# Distributions and value lists of the synthetic contracts.
CREDIT_SCORE = {"mean": 640.0, "std": 90.0, "low": 300.0, "high": 900.0}
ANNUAL_INCOME = {"mean": 12.4, "std": 0.55, "low": 30_000.0, "high": 2_000_000.0}
FINANCED = {"mean": 11.9, "std": 0.6, "low": 20_000.0, "high": 1_500_000.0}
DOWN_PAYMENT = (0.0, 0.4)
TERMS = [24, 36, 48, 60, 72, 84]
TERM_WEIGHTS = [0.1, 0.2, 0.3, 0.2, 0.1, 0.1]
MONTHLY_RATE = {"mean": 1.6, "std": 0.4, "low": 0.6, "high": 3.5}
AGE = {"mean": 45.0, "std": 12.0, "low": 18.0, "high": 80.0}
HARVESTS = [2021, 2022, 2023, 2024, 2025]
UTILISATION_BETA = (2, 3)
PREVIOUS_CONTRACTS_MEAN = 1.5
REGIONS = ["Sul", "Sudeste", "Centro-Oeste", "Nordeste", "Norte"]
EQUIPMENT = ["Trator", "Colheitadeira", "Pulverizador", "Plantadeira", "Implemento"]
NOISE = (0.0, 0.6)

_DRAWS = 23


def generate(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """The feature table for the given keys (column ``id_contrato``).

    A narrow projection: no row moves, and the same key gets the same contract
    in any number of partitions.
    """
    draws = uniforms("contrato", seed, F.col(schema.KEY), _DRAWS)
    drawn = ids.select(
        F.col(schema.KEY).cast("bigint").alias(schema.KEY),
        *[u.alias(f"u{i}") for i, u in enumerate(draws)],
    )
    u = [F.col(f"u{i}") for i in range(_DRAWS)]

    def limited(value, of):
        return clip(value, of["low"], of["high"])

    def normal(first, of):
        return limited(dist.normal(u[first], u[first + 1], of["mean"], of["std"]), of)

    def lognormal(first, of):
        return limited(dist.lognormal(u[first], u[first + 1], of["mean"], of["std"]), of)

    a, b = UTILISATION_BETA
    terms = drawn.select(
        schema.KEY,
        round_half_even(lognormal(4, FINANCED), -2).alias("valor_financiado"),
        dist.uniform(u[6], *DOWN_PAYMENT).alias("_entrada"),
        dist.weighted_choice(u[7], TERMS, TERM_WEIGHTS).cast("bigint").alias("prazo_meses"),
        round_half_even(normal(8, MONTHLY_RATE), 2).alias("taxa_juros"),
        round_half_even(lognormal(2, ANNUAL_INCOME), -2).alias("renda_anual"),
        round_half_even(normal(0, CREDIT_SCORE)).alias("score_credito"),
        round_half_even(normal(10, AGE)).cast("bigint").alias("idade_cliente"),
        dist.choice(u[18], REGIONS).alias("regiao"),
        dist.choice(u[19], EQUIPMENT).alias("tipo_equipamento"),
        dist.choice(u[12], HARVESTS).cast("bigint").alias("safra"),
        round_half_even(clip(dist.beta(u[13 : 13 + a + b - 1], a), 0.0, 1.0), 3).alias(
            "utilizacao_credito"
        ),
        dist.poisson(u[17], PREVIOUS_CONTRACTS_MEAN).alias("num_contratos_anteriores"),
        dist.normal(u[20], u[21], *NOISE).alias("_ruido"),
        u[22].alias("_sorteio"),
    )
    paid = terms.withColumn(
        "valor_entrada", round_half_even(F.col("valor_financiado") * F.col("_entrada"), -2)
    )
    payment = credit.instalment(
        F.col("valor_financiado") - F.col("valor_entrada"),
        F.col("taxa_juros") / F.lit(100.0),
        F.col("prazo_meses"),
    )
    risk = credit.risk_score(
        F.col("_comprometimento"),
        F.col("utilizacao_credito"),
        F.col("score_credito"),
        F.col("prazo_meses"),
        F.col("num_contratos_anteriores"),
        noise=F.col("_ruido"),
    )
    return (
        paid.withColumn("_parcela", payment)
        .withColumn(
            "_comprometimento", credit.commitment_ratio(F.col("_parcela"), F.col("renda_anual"))
        )
        .withColumn("comprometimento_renda", round_half_even(F.col("_comprometimento"), 3))
        .withColumn(schema.LABEL, credit.bernoulli(F.col("_sorteio"), logistic(risk)))
        .select(*schema.FEATURE_TABLE.fieldNames())
    )


def generate_contracts(spark: SparkSession, n: int, seed: int = SEED) -> DataFrame:
    """Contracts 1..n."""
    return generate(spark.range(1, n + 1).withColumnRenamed("id", schema.KEY), seed)
