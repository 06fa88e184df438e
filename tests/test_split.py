import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crivo.operators import split


def by_hand(rows, seed=42):
    """Keys of the test side, ranked per class in plain Python."""
    test = set()
    for label in (0, 1):
        keys = [k for k, y in rows if y == label]
        ranked = sorted(
            keys, key=lambda k: (int(hashlib.md5(f"split|{seed}|{k}".encode()).hexdigest()[:8], 16), k)
        )
        test |= set(ranked[: -(-len(keys) // 5)])
    return test


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i * 7, int(i % 3 == 0)) for i in range(1003)]
    return rows, spark.createDataFrame(rows, "id_contrato long, inadimplente long")


def test_cut_equals_the_ranking(labelled):
    rows, df = labelled
    got = split.stratified_split(df).where("is_test").collect()
    assert {r.id_contrato for r in got} == by_hand(rows)


@pytest.mark.parametrize("partitions", [1, 5])
def test_split_does_not_depend_on_layout(labelled, partitions):
    rows, df = labelled
    shuffled = df.orderBy(F.rand(3)).repartition(partitions)
    got = split.stratified_split(shuffled).where("is_test").collect()
    assert {r.id_contrato for r in got} == by_hand(rows)


def test_equal_hashes_are_ranked_by_key(labelled, monkeypatch):
    """With every hash equal the key alone decides."""
    rows, df = labelled
    monkeypatch.setattr(split, "hash32", lambda name, key: F.lit(5).cast("bigint"))
    got = {r.id_contrato for r in split.stratified_split(df).where("is_test").collect()}
    ones = sorted(k for k, y in rows if y == 1)
    zeros = sorted(k for k, y in rows if y == 0)
    assert got == set(ones[: -(-len(ones) // 5)]) | set(zeros[: -(-len(zeros) // 5)])


def test_share_is_rounded_up_per_class(spark):
    df = spark.createDataFrame(
        [(i, 0) for i in range(6)] + [(10, 1)], "id_contrato long, inadimplente long"
    )
    cuts = {r.inadimplente: r.n_class for r in split.split_cuts(df).collect()}
    assert cuts == {0: 6, 1: 1}
    report = split.split_report(split.stratified_split(df), 21).where("is_test").first()
    assert (report.n_rows, report.n_positive, report.n_features) == (3, 1, 21)


def test_another_seed_gives_another_split(labelled):
    rows, df = labelled
    got = split.stratified_split(df, seed=7).where("is_test").collect()
    assert {r.id_contrato for r in got} == by_hand(rows, 7) != by_hand(rows)


def test_one_class_and_no_rows(labelled):
    _, df = labelled
    ones = split.stratified_split(df.where("inadimplente = 1"))
    assert ones.where("is_test").count() == -(-ones.count() // 5)
    assert split.stratified_split(df.limit(0)).count() == 0


def test_unknown_label_raises(spark):
    df = spark.createDataFrame([(1, 3)], "id_contrato long, inadimplente long")
    with pytest.raises(PySparkException, match="label outside"):
        split.stratified_split(df).collect()


def test_marking_moves_no_row(spark, features):
    from crivo.sources.tables import staged

    cuts = staged(split.split_cuts(features), "cuts")
    plan = split.mark_test_rows(features, cuts)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_row_without_a_key_raises(spark):
    rows = [(i if i >= 30 else None, 0) for i in range(100)]
    df = spark.createDataFrame(rows, "id_contrato long, inadimplente int")
    with pytest.raises(Exception, match="has no id_contrato"):
        split.stratified_split(df).collect()
