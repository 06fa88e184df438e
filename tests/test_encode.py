import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crivo.operators import encode
from crivo.operators.encode import SignatureColumn

AWKWARD = ["Centro-Oeste", "a.b", "com espaço", "til`de", "Sul"]


def categories(spark, data):
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id long, c string")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_vocabulary_is_in_code_point_order(spark):
    df = categories(spark, ["b", "a", "Z", "á", None, "a"])
    assert encode.vocabulary(df, ["c"]) == {"c": ["Z", "a", "b", "á"]}
    rows = encode.vocabulary_table(df, ["c"]).orderBy("pos").collect()
    assert [(r.value, r.pos, r.n) for r in rows] == [
        ("Z", 0, 1), ("a", 1, 2), ("b", 2, 1), ("á", 3, 1),
    ]


def test_too_many_categories_raise(spark, monkeypatch):
    monkeypatch.setattr(encode, "MOST_CATEGORIES", 3)
    with pytest.raises(ValueError, match="categories"):
        encode.vocabulary(categories(spark, ["a", "b", "c", "d"]), ["c"])


def test_awkward_names_and_missing_categories(spark):
    df = categories(spark, [*AWKWARD, None, "unseen"])
    flags = encode.one_hot(df, {"c": AWKWARD}, keep=["id"]).orderBy("id").collect()
    for i, row in enumerate(flags):
        assert list(row)[1:] == [i == j for j in range(len(AWKWARD))]
    signature = [SignatureColumn(f"c_{v}", "boolean", "c", v) for v in AWKWARD]
    aligned = encode.align(df, signature, keep=["id"]).orderBy("id").collect()
    assert aligned == flags
    assert encode.unseen_categories(df, {"c": AWKWARD}).first()["c"] == 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", "z", "w", None]), min_size=1, max_size=30))
def test_flags_sum_to_one_or_none(spark, data):
    df = categories(spark, data)
    known = {"c": ["x", "y", "z"]}
    hot = encode.one_hot(df, known, keep=["c"])
    total = sum((F.col(f"c_{v}").cast("int") for v in known["c"]), F.lit(0))
    for row in hot.select("c", total.alias("t")).collect():
        assert row.t == (1 if row.c in known["c"] else 0)


def test_one_hot_and_align_move_no_row(spark, features):
    vocabulary = encode.vocabulary(features)
    signature = encode.matrix_signature(features, vocabulary)
    assert "Exchange" not in plan(encode.one_hot(features, vocabulary, keep=["id_contrato"]))
    assert "Exchange" not in plan(encode.align(features, signature))


def test_signature_of_the_features(features):
    signature = encode.matrix_signature(features, encode.vocabulary(features))
    assert len(signature) == 21
    assert [c.name for c in signature[:2]] == ["valor_financiado", "valor_entrada"]
    assert {c.type for c in signature[11:]} == {"boolean"}
    assert "regiao_MIDDLE EAST" in [c.name for c in signature]


def test_align_fills_prunes_orders_and_casts(spark):
    df = spark.createDataFrame([(7, 2, "x", 9.0)], "id long, n long, c string, extra double")
    signature = [
        SignatureColumn("c_y", "boolean", "c", "y"),
        SignatureColumn("n", "double"),
        SignatureColumn("c_x", "boolean", "c", "x"),
        SignatureColumn("other_z", "boolean", "other", "z"),
    ]
    aligned = encode.align(df, signature)
    assert aligned.dtypes == [
        ("c_y", "boolean"), ("n", "double"), ("c_x", "boolean"), ("other_z", "boolean"),
    ]
    assert tuple(aligned.first()) == (False, 2.0, True, False)
    assert encode.align(aligned, signature).collect() == aligned.collect()


def test_missing_numeric_column_raises(spark):
    with pytest.raises(ValueError, match="is missing"):
        encode.align(spark.range(1), [SignatureColumn("n", "double")])


def test_unknown_signature_type_raises():
    with pytest.raises(ValueError, match="not in a signature"):
        SignatureColumn("n", "integer")


@pytest.mark.parametrize("target", ["long", "boolean"])
@pytest.mark.parametrize("value", [float("nan"), None])
def test_no_value_for_whole_or_boolean_raises(spark, target, value):
    df = spark.createDataFrame([(value,)], "n double")
    with pytest.raises(PySparkException, match="no value to cast"):
        encode.align(df, [SignatureColumn("n", target)]).collect()


def test_empty_input_keeps_the_schema(spark, features):
    signature = encode.matrix_signature(features, encode.vocabulary(features))
    empty = encode.align(features.limit(0), signature)
    assert empty.count() == 0 and len(empty.columns) == 21


def test_sparse_matrix_of_very_many_categories(spark):
    n = 100_000
    df = spark.range(n + 4).select(
        F.col("id"),
        F.when(F.col("id") < n, F.concat(F.lit("c"), F.col("id"))).alias("big"),
        F.when(F.col("id") % 2 == 0, "even").alias("small"),
        F.when(F.col("id") != 3, F.col("id") * 1.5).alias("x"),
    )
    with pytest.raises(ValueError, match="categories"):
        encode.vocabulary(df, ["big"])
    table = encode.vocabulary_table(df, ["big", "small"])
    late = df.withColumn("big", F.when(F.col("id") == n + 1, "unseen").otherwise(F.col("big")))
    coded = encode.sparse_matrix(late, table, ["id"], ["big", "small"], ["x"])
    place = {r.value: r.pos for r in table.where("column = 'big'").collect()}
    rows = {r.id: r.features for r in coded.where(f"id < 50 OR id >= {n}").collect()}
    for i, vector in rows.items():
        wanted = {0: i * 1.5} if i else {}
        if i < n:
            wanted[1 + place[f"c{i}"]] = 1.0
        if i % 2 == 0:
            wanted[1 + n] = 1.0
        assert vector.size == n + 2
        found = dict(zip(vector.indices.tolist(), vector.values.tolist()))
        if i == 3:
            assert found.pop(0) != found.get(0) and wanted.pop(0)
        assert found == wanted
    assert coded.count() == n + 4


def test_sparse_matrix_agrees_with_the_dense_one(spark, features):
    table = encode.vocabulary_table(features)
    signature = encode.matrix_signature(features, encode.vocabulary(features))
    dense = encode.align(features, signature, keep=["id_contrato"]).orderBy("id_contrato").collect()
    sparse = encode.sparse_matrix(features, table, ["id_contrato"]).orderBy("id_contrato").collect()
    assert [[float(v) for v in row[1:]] for row in dense] == [row.features.toArray().tolist() for row in sparse]
