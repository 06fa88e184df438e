import datetime
import json

import pytest
from pyspark.sql import functions as F

from crivo import schema
from crivo.operators import generate, promotion, registry, scoring, traces
from crivo.operators.forest import ForestParams
from crivo.plans import lifecycle
from crivo.session import fresh_path
from crivo.streaming import point_scoring

WEAK = ForestParams(num_trees=2, max_depth=1, least_partitions=2)
BETTER = ForestParams(num_trees=8, max_depth=5, least_partitions=2)


@pytest.fixture(scope="module")
def ws(spark, features):
    ws = lifecycle.Workspace(spark, "lifecycle_test", fresh_path(spark, "lifecycle"))
    lifecycle.save_features(ws, features)
    assert lifecycle.train_and_register(ws, WEAK, BETTER) == {"champion": 1, "challenger": 2}
    return ws


def test_training_is_logged(ws):
    metrics = registry.run_values(ws.registry.runs(), "metric").collect()
    assert {(r.run_name, r.key) for r in metrics} == {
        (run, key)
        for run in (lifecycle.CHAMPION_RUN, lifecycle.CHALLENGER_RUN)
        for key in ("auc", "accuracy", "f1")
    }
    assert all(0 <= float(r.value) <= 1 for r in metrics)


def test_promotion_and_what_follows(ws, spark):
    decided = lifecycle.evaluate_and_promote(ws, "Risco de crédito", {"dominio": "risco"}).first()
    assert decided.decision == "promoted" and decided.auc_challenger > decided.auc_champion
    assert ws.registry.version_of("champion") == 2
    assert ws.registry.version_of("challenger") is None
    about = {(r.kind, r.key): r.value for r in registry.fold_metadata(ws.registry.events()).collect()}
    assert about == {("description", ""): "Risco de crédito", ("tag", "dominio"): "risco"}

    again = lifecycle.evaluate_and_promote(ws).first()
    assert again.decision == "no_challenger" and ws.registry.version_of("champion") == 2


def test_training_metrics_and_promotion_agree_on_the_holdout(ws):
    logged = {
        (r.run_name, r.key): float(r.value)
        for r in registry.run_values(ws.registry.runs(), "metric").collect()
    }
    decided = lifecycle.evaluate_and_promote(ws).first()
    assert decided.auc_champion in {v for (_, k), v in logged.items() if k == "auc"}


def test_batch_inference(ws, spark, features):
    at = datetime.datetime(2024, 5, 1)
    predicted = lifecycle.batch_inference(ws, scored_at=at)
    assert predicted.columns == [
        "id_contrato", scoring.PREDICTION, "modelo", "versao_modelo", "scored_at",
    ]
    assert dict(predicted.dtypes)[scoring.PREDICTION] == "int"
    assert predicted.count() == features.count()
    assert predicted.select("versao_modelo", "scored_at").distinct().count() == 1
    classes = scoring.class_distribution(predicted).collect()
    assert [r[0] for r in classes] == [0, 1] and sum(r.n for r in classes) == features.count()

    replaced = lifecycle.batch_inference(ws, with_probability=True)
    assert replaced.columns == [
        "id_contrato", scoring.PREDICTION, scoring.PROBABILITY, "modelo", "versao_modelo",
        "scored_at",
    ]
    assert replaced.where(f"{scoring.PROBABILITY} <> round({scoring.PROBABILITY}, 4)").isEmpty()


def test_point_scoring_leaves_spans(ws, spark):
    answers = lifecycle.point_scoring(ws, lifecycle.first_of_features(ws), "p1")
    assert sorted(r.id_contrato for r in answers.collect()) == list(range(5))
    stored = spark.table(traces.span_table_name(ws.namespace, lifecycle.TRACE_PREFIX))
    assert traces.count_spans(stored).first().n_spans == 5
    assert json.loads(stored.first().outputs).keys() == {"inadimplente", "prob"}


def test_payloads_and_audit(ws, spark):
    contracts = spark.table(ws.table(lifecycle.FEATURES))
    for run in ("r1", "r2"):
        lifecycle.point_scoring(
            ws, contracts, run, traces.PAYLOAD_SPAN, lifecycle.PAYLOAD_TRACE_PREFIX, True
        )
    audited = lifecycle.audit_payloads(ws)
    assert audited.count() == 2 * contracts.count()
    assert audited.where("id_contrato IS NULL").isEmpty()
    assert audited.select("payload_uri").distinct().count() == 2 * contracts.count()


def test_retraining_may_keep_the_champion(ws):
    before = ws.registry.version_of("champion")
    versions = lifecycle.train_and_register(ws, WEAK, WEAK, keep_champion=True)
    assert ws.registry.version_of("champion") == before
    assert ws.registry.version_of("challenger") == versions["challenger"]
    versions = lifecycle.train_and_register(ws, WEAK, WEAK)
    assert ws.registry.version_of("champion") == versions["champion"]
    assert lifecycle.evaluate_and_promote(ws).first().decision == "kept"
    assert ws.registry.version_of("challenger") == versions["challenger"]


def test_stream_gives_the_answers_of_the_batch(ws, spark, features):
    arriving, output = fresh_path(spark, "arriving"), fresh_path(spark, "spans")
    request = features.select(schema.KEY, *schema.REQUEST.fieldNames())
    request.repartition(3).write.json(arriving)
    model = ws.registry.load("champion")
    checkpoint = fresh_path(spark, "checkpoint")

    def run():
        contracts = point_scoring.arriving_contracts(spark, arriving)
        point_scoring.store_spans_of_arrivals(
            contracts, model, output, checkpoint
        ).awaitTermination()
        return spark.read.schema(traces.SPANS).parquet(output)

    spans = run()
    assert spans.count() == features.count()
    answers = spans.select("id_contrato", F.from_json("outputs", schema.RESPONSE).alias("r"))
    batch, _ = lifecycle.answer(ws, features)
    assert sorted(map(tuple, answers.select("id_contrato", "r.*").collect())) == sorted(
        map(tuple, batch.select("id_contrato", "inadimplente", "prob").collect())
    )
    assert run().count() == features.count()
    request.limit(4).write.mode("append").json(arriving)
    assert run().count() == features.count() + 4
    # Lines that are no contracts, or lack a whole number, go aside.
    broken = ['{"id_contrato": 1, "prazo', '{"id_contrato": "x"}', '{"id_contrato": 7}']
    spark.createDataFrame([(t,) for t in broken], "value string").write.mode("append").text(arriving)
    request.limit(2).write.mode("append").json(arriving)
    assert run().count() == features.count() + 6
    aside = spark.read.json(f"{output}_rejected").collect()
    assert sorted((r.id_contrato or 0, r.line or "") for r in aside) == [(0, broken[1]), (0, broken[0]), (7, "")]


def test_repeated_run_replaces_what_it_stored(ws):
    def score(run_id):
        lifecycle.point_scoring(
            ws, lifecycle.first_of_features(ws), run_id=run_id, name=traces.PAYLOAD_SPAN,
            prefix="again", with_payload=True,
        )
        return lifecycle.audit_payloads(ws, prefix="again")

    assert score("again/1").count() == lifecycle.POINT_ROWS
    assert score("again/1").count() == lifecycle.POINT_ROWS
    audited = score("again/2")
    assert audited.count() == 2 * lifecycle.POINT_ROWS
    assert audited.where("id_contrato IS NULL").isEmpty()


def test_generated_contracts(spark):
    contracts = generate.generate_contracts(spark, 4000)
    assert contracts.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schema.FEATURE_TABLE.fields
    ]
    row = contracts.agg(
        F.min("id_contrato"), F.max("id_contrato"), F.countDistinct("id_contrato"),
        F.avg("score_credito"), F.avg("utilizacao_credito"), F.avg("num_contratos_anteriores"),
        F.countDistinct("regiao"), F.countDistinct("tipo_equipamento"), F.countDistinct("safra"),
        F.avg("inadimplente"), F.min("valor_financiado"), F.max("comprometimento_renda"),
    ).first()
    assert row[:3] == (1, 4000, 4000)
    assert row[3] == pytest.approx(640, abs=6) and row[4] == pytest.approx(0.4, abs=0.02)
    assert row[5] == pytest.approx(1.5, abs=0.1) and row[6:9] == (5, 5, 5)
    assert 0.1 < row[9] < 0.6 and row[10] >= 20_000 and row[11] <= 3.0
    assert sorted(contracts.collect()) == sorted(
        generate.generate(spark.range(1, 4001).toDF("id_contrato").repartition(7)).collect()
    )


def test_decision_without_champion(spark):
    df = spark.createDataFrame([("challenger", 0.9)], "alias string, auc double")
    assert promotion.decide(df).first().decision == "undefined"
