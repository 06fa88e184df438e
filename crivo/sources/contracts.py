"""The contract table, derived from the order tables: one order, one contract."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions import credit
from crivo.functions.hashing import hash32
from crivo.functions.numeric import clip, logistic, round_half_even, unsigned_zero
from crivo.operators.skew import HOT_ROWS, hot_keys, position_in_group, salted_left_join, time_levels
from crivo.sources.tables import read_parquet

_LABEL_STEPS = 1_000_000


def contract_terms(spark: SparkSession, folder: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Terms of every contract, before anything that depends on the instalment.

    Orders move twice: by order key to meet the line items, and by customer for
    the contract history, which the customer join then shares. Customers with
    more than ``hot_rows`` orders are spread over tasks in both places.
    """
    orders = read_parquet(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    lines = (
        read_parquet(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"))
    )
    regions = read_parquet(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("regiao")
    )
    nations = (
        read_parquet(spark, folder, "nation")
        .select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        .join(regions, "n_regionkey", "left")
        .select("c_nationkey", "regiao")
    )
    # Regions meet the customers first: a nation is a hot key of the orders.
    customers = (
        read_parquet(spark, folder, "customer")
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(nations, "c_nationkey", "left")
        .select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment", "regiao")
    )

    hot = hot_keys(orders, "o_custkey", hot_rows)
    priced = orders.join(lines, "o_orderkey", "left")
    ranked = position_in_group(
        priced,
        group="o_custkey",
        order=["o_orderdate", "o_orderkey"],
        levels=time_levels(F.col("o_orderdate"), F.col("o_orderkey")),
        name="num_contratos_anteriores",
        hot=hot,
    )
    owned = salted_left_join(
        ranked, customers, ["o_custkey"], "o_custkey", F.col("o_orderkey"), hot
    )

    # Which of two equal zeros a maximum returns is up to the engine.
    discount = unsigned_zero(F.coalesce(F.col("discount"), F.lit(0.0)))
    tax = F.coalesce(F.col("tax"), F.lit(0.0))
    financed = round_half_even(clip(F.col("o_totalprice"), 20_000.0, 1_500_000.0), -2)
    share = F.least(discount * F.lit(4.0), F.lit(0.4))
    return (
        owned.withColumn("valor_financiado", financed)
        .withColumn("valor_entrada", round_half_even(F.col("valor_financiado") * share, -2))
        .select(
            F.col("o_orderkey").alias("id_contrato"),
            "valor_financiado",
            "valor_entrada",
            (F.lit(24) + F.lit(12) * (F.col("o_orderkey") % 6)).cast("bigint").alias("prazo_meses"),
            round_half_even(F.lit(0.6) + tax * F.lit(20.0), 2).alias("taxa_juros"),
            clip(F.col("c_acctbal") * F.lit(20.0), 30_000.0, 2_000_000.0).alias("renda_anual"),
            (F.lit(300) + hash32("score", F.col("o_orderkey")) % 601)
            .cast("double")
            .alias("score_credito"),
            (F.lit(18) + F.col("o_custkey") % 63).cast("bigint").alias("idade_cliente"),
            "regiao",
            F.col("c_mktsegment").alias("tipo_equipamento"),
            F.year("o_orderdate").cast("bigint").alias("safra"),
            F.least(discount * F.lit(8.0), F.lit(1.0)).alias("utilizacao_credito"),
            "num_contratos_anteriores",
        )
    )


def with_commitment(terms: DataFrame) -> DataFrame:
    """Add the instalment and the unrounded share of income it takes."""
    payment = credit.instalment(
        F.col("valor_financiado") - F.col("valor_entrada"),
        F.col("taxa_juros") / F.lit(100.0),
        F.col("prazo_meses"),
    )
    return terms.withColumn("parcela", payment).withColumn(
        "comprometimento", credit.commitment_ratio(F.col("parcela"), F.col("renda_anual"))
    )


def with_fixed_scores(contracts: DataFrame) -> DataFrame:
    """Add two fixed scorecards: the full one and one that ignores utilisation.

    They need the unrounded commitment, since the score is taken before the
    feature is rounded.
    """

    def score(**weights):
        return credit.risk_score(
            F.col("comprometimento"),
            F.col("utilizacao_credito"),
            F.col("score_credito"),
            F.col("prazo_meses"),
            F.col("num_contratos_anteriores"),
            **weights,
        )

    return (
        contracts.withColumn("risco", score())
        .withColumn("prob_exata", logistic(F.col("risco")))
        .withColumn("prob", round_half_even(F.col("prob_exata"), 6))
        .withColumn(
            "prob_sem_utilizacao", round_half_even(logistic(score(utilisation_weight=0.0)), 6)
        )
    )


def with_label(contracts: DataFrame) -> DataFrame:
    """Add the default label, drawn from a hash of the contract."""
    draw = (hash32("label", F.col(schema.KEY)) % _LABEL_STEPS) / F.lit(float(_LABEL_STEPS))
    return contracts.withColumn(schema.LABEL, credit.bernoulli(draw, F.col("prob_exata")))


def scored_contracts(spark: SparkSession, folder: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Contract features, fixed scores and label, all columns unpruned; Spark
    drops what a query does not use."""
    terms = contract_terms(spark, folder, hot_rows)
    rounded = round_half_even(F.col("comprometimento"), 3)
    return with_label(with_fixed_scores(with_commitment(terms))).withColumn(
        "comprometimento_renda", rounded
    )


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table: key, features and label, one row per contract."""
    return scored_contracts(spark, folder).select(*schema.FEATURE_TABLE.fieldNames())
