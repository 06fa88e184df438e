from pyspark.sql import Row
from pyspark.sql import functions as F

from crivo.operators import audit, skew
from crivo.operators.registry import number_versions
from crivo.sources.contracts import scored_contracts


def lopsided(spark):
    """One group holds a third of the rows, many at the same moment."""
    return spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, (id * 37 % 60) / 8.0)").alias("ts"),
        (F.col("id") * 3_000_017).alias("key"),
    )


def ranked(df, hot):
    return sorted(
        skew.position_in_group(
            df, "g", ["ts", "key"], skew.time_levels(F.col("ts"), F.col("key")), "pos", hot
        ).collect()
    )


def test_hot_keys(spark):
    df = lopsided(spark)
    assert skew.hot_keys(df, "g", 1000) is None
    assert [r.g for r in skew.hot_keys(df, "g", 100).collect()] == ["hot"]


def test_too_many_hot_keys_raise_the_limit(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_HOT_KEYS", 3)
    assert [r.g for r in skew.hot_keys(lopsided(spark), "g", 2).collect()] == ["hot"]


def test_rank_of_hot_groups_is_the_plain_rank(spark):
    df = lopsided(spark)
    plain = ranked(df, None)
    assert ranked(df, skew.hot_keys(df, "g", 100)) == plain
    assert ranked(df, skew.hot_keys(df, "g", 1)) == plain


def test_rank_holds_with_missing_values(spark):
    df = lopsided(spark).withColumn("ts", F.when(F.col("key") % 4 != 0, F.col("ts")))
    df = df.withColumn("g", F.when(F.col("g") != "g1", F.col("g")))

    def order(rows):
        return sorted((str(r.g), str(r.ts), r.key, r.pos) for r in rows)

    def run(hot):
        return order(
            skew.position_in_group(
                df, "g", ["ts", "key"], skew.time_levels(F.col("ts"), F.col("key")), "pos", hot
            ).collect()
        )

    assert run(skew.hot_keys(df, "g", 1)) == run(None)


def test_a_hot_group_is_never_in_one_window(spark):
    df = lopsided(spark)
    plan = skew.position_in_group(
        df, "g", ["ts", "key"], skew.time_levels(F.col("ts"), F.col("key")), "pos",
        skew.hot_keys(df, "g", 100),
    )._jdf.queryExecution().optimizedPlan().toString()
    ranks = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert ranks and all("_level4" in line for line in ranks)


def test_salted_join_is_the_plain_join(spark):
    left = lopsided(spark)
    right = spark.createDataFrame(
        [Row(g="hot", v=1), Row(g="hot", v=2), Row(g="g1", v=3)], "g string, v int"
    )
    args = (left, right, ["g"], "g", F.col("key"))
    plain = sorted(map(str, skew.salted_left_join(*args, None).collect()))
    salted = skew.salted_left_join(*args, skew.hot_keys(left, "g", 100), salts=7)
    assert sorted(map(str, salted.collect())) == plain


def test_contracts_with_hot_customers_are_the_same(spark, small):
    plain = sorted(map(str, scored_contracts(spark, small).collect()))
    split = scored_contracts(spark, small, hot_rows=5)
    assert sorted(map(str, split.select(*scored_contracts(spark, small).columns).collect())) == plain


def test_version_numbers_of_hot_models(spark):
    events = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 9)).alias("model"),
        (F.col("id") * 700_001).alias("seq"),
        F.lit("register").alias("op"),
        F.lit(None).cast("string").alias("value"),
    )
    plain = sorted(map(str, number_versions(events).select("model", "seq", "version").collect()))
    hot = number_versions(events, hot_rows=50).select("model", "seq", "version")
    assert sorted(map(str, hot.collect())) == plain


def test_audit_of_a_shared_uri(spark):
    refs = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "/hot").otherwise(F.concat(F.lit("/u"), "id")).alias("payload_uri"),
        F.col("id").alias("id_contrato_trace"),
        F.lit(10).cast("bigint").alias("payload_bytes"),
    )
    payloads = refs.select("payload_uri").distinct().where("payload_uri <> '/u1'").select(
        "payload_uri",
        F.lit(1).cast("bigint").alias("id_contrato"),
        F.lit("1").alias("versao_modelo"),
        F.struct(F.lit(1).cast("bigint").alias("inadimplente"), F.lit(0.5).alias("prob")).alias("response"),
    )
    plain = sorted(map(str, audit.audit(refs, payloads).collect()))
    assert len(plain) == 300
    assert sorted(map(str, audit.audit(refs, payloads, hot_rows=20).collect())) == plain
