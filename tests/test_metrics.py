import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from crivo.operators import metrics, promotion
from crivo.sources.contracts import scored_contracts
from crivo.sources.tables import staged


def scored(spark, rows):
    return spark.createDataFrame(rows, "inadimplente long, prob double")


def pairwise(rows):
    positive = [p for y, p in rows if y == 1]
    negative = [p for y, p in rows if y == 0]
    if not positive or not negative:
        return None
    won = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return won / (len(positive) * len(negative))


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 1),
            st.one_of(st.floats(0, 1), st.sampled_from([0.0, 0.25, 0.5, 0.25 + 1e-14, 1.0])),
        ),
        min_size=1,
        max_size=40,
    )
)
@example([(1, 0.5), (0, 0.5), (1, 0.3), (0, 0.3 + 2**-54)])
@example([(1, 5e-324), (0, 0.0), (0, 1e-300), (1, 1e-13)])
def test_auc_is_the_share_of_won_pairs(spark, rows):
    wanted = pairwise(rows)
    got = metrics.auc(scored(spark, rows)).first().auc
    assert got is None if wanted is None else got == pytest.approx(wanted, abs=1e-15)


def test_auc_agrees_with_the_exact_evaluator(spark, small):
    df = scored_contracts(spark, small).select("inadimplente", "prob")
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="prob", labelCol="inadimplente", numBins=0
    )
    assert metrics.auc(df).first().auc == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_auc_of_a_hot_score(spark):
    """A third of the rows share one score: they are one row after counting."""
    rows = [(i % 2, 0.5) for i in range(300)] + [(i % 2, i / 600) for i in range(600)]
    assert metrics.auc(scored(spark, rows)).first().auc == pytest.approx(pairwise(rows), abs=1e-15)


def test_no_window_takes_whole_groups_of_raw_scores(spark, small):
    plan = metrics.auc(scored_contracts(spark, small))._jdf.queryExecution().toString()
    alone = [p for p in plan.splitlines() if "Window" in p and "_score" in p]
    assert alone and all("_part" in p for p in alone)


def test_auc_of_scores_that_all_lie_close(spark, monkeypatch):
    """Ranges split scores below 1e-12 as they split others."""
    rows = [(i * 7 % 3 % 2, (i * 37 % 1000) * 1e-16) for i in range(3000)]
    df = scored(spark, rows).withColumn("m", F.when(F.col("inadimplente") >= 0, "a"))
    by_model = df.unionByName(df.withColumn("m", F.lit(None).cast("string")).withColumn("prob", F.col("prob") / 2))
    got = {r.m: r.auc for r in metrics.auc(by_model, by=("m",)).collect()}
    wanted = pytest.approx(pairwise(rows), abs=1e-15)
    assert got == {"a": wanted, None: wanted}
    # Small ranges are not merged here, to see how the scores are dealt.
    written = []
    monkeypatch.setattr(metrics, "staged", lambda df, name: written.append(staged(df, name)) or written[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        metrics.auc(scored(spark, rows)).collect()
        sizes = [r["count"] for r in written[0].groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 1000 and len(sizes) > 1 and max(sizes) < 700


@pytest.mark.parametrize(
    "row", [(1, None), (1, float("nan")), (None, 0.5), (2, 0.5), (1, 1.5), (0, -0.1)]
)
def test_rows_without_score_or_label_raise(spark, row):
    with pytest.raises(PySparkException, match="AUC needs"):
        metrics.auc(scored(spark, [(0, 0.1), row])).collect()


def test_metrics_by_hand(spark):
    rows = [(1, 0.9), (1, 0.5), (1, 0.2), (0, 0.8), (0, 0.1), (0, 0.3)]
    got = metrics.evaluate(scored(spark, rows).withColumn("m", F.lit("a")), by="m").first()
    assert got.accuracy == pytest.approx(4 / 6) and got.f1 == pytest.approx(4 / 6)
    assert got.auc == pytest.approx(pairwise(rows))
    classed = scored(spark, rows).withColumn("predicao", (F.col("prob") >= 0.5).cast("int"))
    assert metrics.confusion_counts(classed).first().asDict() == {
        "tp": 2, "fp": 1, "tn": 2, "fn": 1,
    }
    assert metrics.classification_metrics(classed).first().f1 == pytest.approx(4 / 6)


def test_f1_without_positives_is_zero(spark):
    df = scored(spark, [(0, 0.1), (0, 0.2)]).withColumn("predicao", F.lit(0))
    got = metrics.classification_metrics(df).first()
    assert got.f1 == 0.0 and got.accuracy == 1.0


def test_default_rate(spark):
    got = metrics.default_rate(scored(spark, [(1, 0.0), (0, 0.0), (0, 0.0), (1, 0.0)])).first()
    assert tuple(got) == (4, 2, 0.5)


def decision(spark, champion, challenger):
    rows = [("champion", champion)] + ([("challenger", challenger)] if challenger != "none" else [])
    df = spark.createDataFrame(rows, "alias string, auc double")
    return promotion.decide(df).first().decision


@pytest.mark.parametrize(
    "champion, challenger, wanted",
    [
        (0.7, 0.8, "promoted"),
        (0.8, 0.7, "kept"),
        (0.8, 0.8, "kept"),
        (None, 0.8, "undefined"),
        (0.8, None, "undefined"),
        (0.8, "none", "no_challenger"),
    ],
)
def test_decision(spark, champion, challenger, wanted):
    assert decision(spark, champion, challenger) == wanted
