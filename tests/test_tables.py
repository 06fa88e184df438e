import datetime
import threading

import pytest
from pyspark.sql import functions as F

from crivo.session import fresh_path, shared_folder
from crivo.sources import tables


@pytest.fixture
def namespace(spark):
    tables.ensure_namespace(spark, "tables_test", fresh_path(spark, "tables_test"))
    yield "tables_test"
    spark.sql("DROP SCHEMA tables_test CASCADE")


def test_replace_changes_contents_and_schema(spark, namespace):
    t = f"{namespace}.t"
    tables.replace_table(spark.range(3), t)
    replaced = tables.replace_table(spark.range(2).select(F.lit("x").alias("s")), t)
    assert replaced.columns == ["s"] and spark.table(t).count() == 2


def test_replace_by_a_query_over_itself(spark, namespace):
    t = f"{namespace}.t"
    old = tables.replace_table(spark.range(5), t)
    new = tables.replace_table(old.where("id > 1").withColumn("twice", F.col("id") * 2), t)
    assert sorted(map(tuple, new.collect())) == [(2, 4), (3, 6), (4, 8)]


def test_a_failed_replace_leaves_the_table(spark, namespace):
    t = f"{namespace}.t"
    tables.replace_table(spark.range(5), t)
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(spark.range(1).select(F.raise_error(F.lit("boom")).alias("x")), t)
    assert spark.table(t).count() == 5


def test_replace_with_partitions(spark, namespace):
    df = spark.range(6).withColumn("p", F.col("id") % 2)
    replaced = tables.replace_table(df, f"{namespace}.t", partition_by=["p"])
    assert replaced.where("p = 1").count() == 3


def test_a_reader_never_misses_the_name(spark, namespace):
    t = f"{namespace}.read"
    tables.replace_table(spark.range(10), t)
    seen, failed, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add(spark.table(t).count())
            except Exception as error:
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(11, 19):
        tables.replace_table(spark.range(n).withColumn(f"c{n}", F.lit(n)), t)
    done.set()
    reader.join()
    assert not failed and seen <= set(range(10, 19)) and spark.table(t).columns == ["id", "c18"]


def test_old_versions_go_after_their_age(spark, namespace):
    t = f"{namespace}.aged"
    old = tables.replace_table(spark.range(1), t)
    for n in (2, 3):
        tables.replace_table(spark.range(n), t)
    tables.replace_table(spark.range(9), f"{t}_other")
    assert tables.drop_old_versions(spark, t, datetime.timedelta(hours=1)) == []
    assert old.count() == 1
    assert len(tables.drop_old_versions(spark, t, datetime.timedelta(0))) == 2
    assert spark.table(t).count() == 3 and spark.table(f"{t}_other").count() == 9
    assert tables.drop_old_versions(spark, t, datetime.timedelta(0)) == []
    assert tables.drop_old_versions(spark, "nowhere.t", datetime.timedelta(0)) == []


def test_append_creates_then_adds(spark, namespace):
    for _ in range(2):
        added = tables.append_table(spark.range(3), f"{namespace}.log")
    assert added.count() == 6


def test_prefix_is_literal(spark, namespace):
    for name in ("traces_a", "tracesxa", "other"):
        tables.replace_table(spark.range(1), f"{namespace}.{name}")
    assert [r.table_name for r in tables.tables_with_prefix(spark, namespace, "traces_").collect()] == [
        "traces_a"
    ]


def test_schema_report(spark):
    rows = tables.schema_report(spark.range(1).withColumn("s", F.lit("x"))).collect()
    assert [tuple(r) for r in rows] == [(0, "id", "bigint", False), (1, "s", "string", False)]


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_scratch_removes_what_is_staged_in_it(spark):
    with tables.scratch(spark):
        outer = tables.staged(spark.range(3), "outer")
        with tables.scratch(spark):
            inner = tables.staged(spark.range(4), "inner")
            result = tables.staged(inner.where("id > 1"), "result", result=True)
        with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
            inner.collect()
        assert result.count() == 2 and outer.count() == 3
        kept = tables.staged(result, "kept", result=True)
    assert kept.count() == 2
    for gone in (outer, result):
        with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
            gone.collect()
    alone = tables.staged(spark.range(1), "alone")
    assert alone.count() == 1


def test_scratch_ends_after_errors(spark):
    with pytest.raises(KeyError):
        with tables.scratch(spark):
            lost = tables.staged(spark.range(3), "lost")
            raise KeyError
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        lost.collect()
    assert tables._scopes.get() == []


def test_a_local_cluster_is_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from crivo import session

    def named(master):
        conf = SimpleNamespace(get=lambda key, default: default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert session.shared_folder(named("local")) == session.shared_folder(named("local[4]"))
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(named(master))
