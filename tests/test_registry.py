import random

import pytest

from crivo.operators import encode, promotion, registry
from crivo.operators.forest import ForestParams, fit_forest, score_forest

LOG = [
    ("m", 1, "register", None, 1, "p1", "a"),
    ("m", 2, "set_alias", "champion", 1, None, "a"),
    ("m", 3, "register", None, 2, "p2", "a"),
    ("m", 4, "set_alias", "challenger", 2, None, "a"),
    ("m", 5, "set_alias", "champion", 2, None, "b"),
    ("m", 6, "delete_alias", "challenger", None, None, "b"),
    ("m", 7, "set_tag", "owner", None, "x", "b"),
    ("m", 8, "set_tag", "owner", None, "y", "b"),
    ("m", 9, "set_description", None, None, "first", "b"),
    ("m", 10, "set_description", None, None, "second", "b"),
    ("n", 1, "set_alias", "champion", 9, None, "a"),
]


@pytest.mark.parametrize("seed", range(3))
def test_fold_does_not_depend_on_row_order(spark, seed):
    rows = LOG[:]
    random.Random(seed).shuffle(rows)
    events = spark.createDataFrame(rows, registry.EVENTS).repartition(3)
    assert sorted(map(tuple, registry.fold_aliases(events).collect())) == [
        ("m", "champion", 2), ("n", "champion", 9),
    ]
    assert sorted(map(tuple, registry.fold_metadata(events).collect())) == [
        ("m", "description", "", "second"), ("m", "tag", "owner", "y"),
    ]
    assert sorted(r.version for r in registry.fold_versions(events).collect()) == [1, 2]


def test_numbers_used_twice_are_found(spark):
    events = spark.createDataFrame([*LOG, LOG[0]], registry.EVENTS)
    assert [(r.model, r.seq) for r in registry.duplicate_sequence_numbers(events).collect()] == [
        ("m", 1)
    ]


@pytest.fixture
def fitted(features):
    signature = encode.matrix_signature(features, encode.vocabulary(features))
    return fit_forest(features, signature, ForestParams(2, 2, least_partitions=2)), signature


def test_versions_aliases_and_loading(spark, folder, features, fitted):
    forest, signature = fitted
    log = registry.Registry(spark, folder, "m")
    assert log.version_of("champion") is None and log.events().count() == 0
    assert log.register(forest, signature, features.limit(3)) == 1
    assert log.register(forest, signature) == 2
    log.set_alias("champion", 1)
    log.set_alias("challenger", 2)
    loaded = log.load("champion")
    assert loaded.version == 1 and loaded.signature == signature
    before = score_forest(features, forest, signature, keep=["id_contrato"])
    after = score_forest(features, loaded.forest, loaded.signature, keep=["id_contrato"])
    assert sorted(before.collect()) == sorted(after.collect())

    promotion.apply_decision(log, "kept")
    assert log.version_of("champion") == 1
    promotion.apply_decision(log, "promoted")
    assert log.version_of("champion") == 2 and log.version_of("challenger") is None
    assert registry.fold_versions(log.events()).count() == 2
    log.set_alias("challenger", 1)
    assert log.version_of("challenger") == 1

    with pytest.raises(ValueError, match="no version 3"):
        log.set_alias("champion", 3)
    with pytest.raises(ValueError, match="no alias"):
        log.load("nobody")
    assert {r.actor for r in log.events().collect()} == {spark.sql("SELECT current_user()").first()[0]}


def test_models_share_a_folder(spark, folder):
    one, two = (registry.Registry(spark, folder, name) for name in ("one", "two"))
    one.set_tag("k", "1")
    two.set_tag("k", "2")
    one.set_tag("k", "3")
    found = {(r.model, r.value) for r in registry.fold_metadata(one.events()).collect()}
    assert found == {("one", "3"), ("two", "2")}


def test_two_writers_are_noticed(spark, folder):
    log = registry.Registry(spark, folder, "m")
    log.set_tag("k", "1")
    log._record(0, "set_tag", key="k", value="2")
    with pytest.raises(ValueError, match="two writers"):
        log.set_tag("k", "3")


def test_runs(spark, folder):
    log = registry.Registry(spark, folder, "m")
    log.log_run("r1", "first", {"n_estimators": 100}, {"auc": 0.75})
    assert [tuple(r) for r in registry.run_values(log.runs(), "metric").collect()] == [
        ("r1", "first", "auc", "0.75")
    ]
    assert registry.run_values(log.runs(), "param").first().value == "100"


@pytest.mark.parametrize("step", ["forest", "signature", "event"])
def test_failed_registration_leaves_no_version(spark, folder, fitted, monkeypatch, step):
    forest, signature = fitted
    log = registry.Registry(spark, folder, "torn")

    def fail(*args, **kwargs):
        raise OSError("stopped")

    with monkeypatch.context() as torn:
        if step == "forest":
            torn.setattr(type(forest), "save", fail)
        elif step == "signature":
            torn.setattr(registry, "signature_table", fail)
        else:
            torn.setattr(log, "_record", fail)
        with pytest.raises(OSError):
            log.register(forest, signature)
    assert log.register(forest, signature) == 1
    log.set_alias("champion", 1)
    assert log.load("champion").signature == signature
