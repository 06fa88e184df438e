"""Schemas found in JSON documents, and audits of both sides."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.operators import audit
from crivo.sources import inference

DOCUMENTS = [
    {"id": 1, "a": {"x": 1, "y": None}, "l": [1, 2.5], "dot.ted": "s", "e": []},
    {"id": 2, "a": {"x": 2.0, "y": "t"}, "l": [], "o": [{"k": True}, {"k": False, "m": 1}]},
    {"id": "three", "a": {"x": 1e300}, "b": [[1], []]},
    {"id": None, "[]": 1},
]


def fields(spark, documents):
    lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    found = inference.json_fields(spark.createDataFrame([(t,) for t in lines], "value string").repartition(3), "value")
    return found


def test_types_and_conflicts(spark):
    rows = {tuple(r.path): r for r in fields(spark, [*DOCUMENTS, "{broken"]).collect()}
    assert rows[()].n_object == 4 and rows[()].n_corrupt == 1
    assert {p: r.type for p, r in rows.items() if not r.conflict} == {
        (): "object", ("a",): "object", ("a", "x"): "double", ("a", "y"): "string", ("l",): "array",
        ("l", "[]"): "double", ("dot.ted",): "string", ("e",): "array", ("o",): "array", ("o", "[]"): "object",
        ("o", "[]", "k"): "boolean", ("o", "[]", "m"): "long", ("b",): "array", ("b", "[]"): "array",
        ("b", "[]", "[]"): "long", ("[]",): "long",
    }
    clash = rows[("id",)]
    assert (clash.type, clash.conflict, clash.n_long, clash.n_string, clash.n_null) == ("string", True, 2, 1, 1)


def test_documents_are_read_by_the_schema_found(spark, tmp_path):
    found = inference.inferred_schema(fields(spark, DOCUMENTS))
    assert found["a"].dataType == T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType())])
    assert found["b"].dataType == T.ArrayType(T.ArrayType(T.LongType()))
    (tmp_path / "d.json").write_text("\n".join(map(json.dumps, DOCUMENTS)))
    rows = spark.read.schema(found).json(str(tmp_path)).orderBy(F.col("a.x")).collect()
    assert [r.id for r in rows] == [None, "1", "2", "three"]
    assert rows[2].o[1].m == 1 and rows[1].l == [1.0, 2.5] and rows[1]["dot.ted"] == "s"


def test_fields_of_two_sets_merge(spark):
    both = inference.merged_fields(fields(spark, DOCUMENTS[:2]), fields(spark, DOCUMENTS[2:]))
    assert sorted(map(str, both.collect())) == sorted(map(str, fields(spark, DOCUMENTS).collect()))


def test_no_documents_and_no_objects(spark):
    assert fields(spark, ["1"]).count() == 1
    with pytest.raises(ValueError, match="no objects"):
        inference.inferred_schema(fields(spark, ["1", "[2]"]))
    assert inference.json_fields(spark.createDataFrame([], "value string"), "value").isEmpty()
    assert "json_level" not in str(spark.catalog.listTables())


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_one_join_gives_the_audit_and_both_kinds_of_orphans(spark, hot_rows):
    rows = [("/a", i, 10) for i in range(500)] + [("/lost", i, 10) for i in range(300)] + [("/b", 1, 1), (None, 2, 2)]
    refs = spark.createDataFrame(rows, "payload_uri string, id_contrato_trace long, payload_bytes long")
    stored = [("/a", 1, "1", (1, 0.5)), ("/b", 2, "1", (0, 0.2)), ("/alone", 3, "1", (0, 0.1)), (None, 4, "1", (0, 0.3))]
    payloads = spark.createDataFrame(
        stored,
        "payload_uri string, id_contrato long, versao_modelo string,"
        " response struct<inadimplente: long, prob: double>",
    )
    audited = audit.audit_all(refs, payloads, hot_rows)
    counts = {(r.kind, r.payload_uri): r["count"] for r in audited.groupBy("kind", "payload_uri").count().collect()}
    assert counts == {
        ("matched", "/a"): 500, ("matched", "/b"): 1, ("span_without_payload", "/lost"): 300,
        ("span_without_payload", None): 1, ("payload_without_span", "/alone"): 1, ("payload_without_span", None): 1,
    }
    assert audited.where("payload_uri = '/a' AND prob = 0.5 AND id_contrato = 1").count() == 500
    orphans = audit.references_without_payload(refs, payloads, hot_rows)
    assert orphans.columns == refs.columns and orphans.count() == 301


def counted_one_by_one(documents):
    """(path, family) of every value of the documents."""
    families = {bool: "boolean", int: "long", float: "double", str: "string", type(None): "null"}

    def inside(path, value):
        if isinstance(value, (dict, list)):
            yield path, "object" if isinstance(value, dict) else "array"
            named = value.items() if isinstance(value, dict) else (("[]", v) for v in value)
            for name, member in named:
                yield from inside((*path, name), member)
        else:
            yield path, families[type(value)]

    return collections.Counter(c for d in documents for c in inside((), d))


def test_shapes_count_as_values_one_by_one(spark):
    names = ["a", "b_1", "BIGINT", "OBJECT", "ARRAY", "a: BIGINT, b", "`", "", "7", "é", "DOUBLE>"]
    draw = random.Random(5)

    def value(depth):
        kind = draw.randrange(9 if depth < 4 else 6)
        if kind > 5:
            some = draw.sample(names, draw.randrange(4))
            return [value(depth + 1) for _ in some] if kind == 8 else {n: value(depth + 1) for n in some}
        return (draw.randrange(9), 2.25, 1e300, "BIGINT", None, True)[kind]

    documents = [value(0) for _ in range(400)]
    numbers = ("long", "double", "string", "boolean", "object", "array", "null")
    rows = fields(spark, list(map(json.dumps, documents))).collect()
    found = {(tuple(r.path), k): r[f"n_{k}"] for r in rows for k in numbers if r[f"n_{k}"]}
    assert found == counted_one_by_one(documents)


def test_documents_are_read_once_for_each_level_of_arrays(spark, folder):
    """What is returned reads counts, not the documents again for each level."""
    lines = [json.dumps({"a": {"b": {"c": i, "d": 0.5}}}) for i in range(50)]
    spark.createDataFrame([(t,) for t in lines], "value string").write.text(folder)
    found = inference.json_fields(spark.read.text(folder), "value")
    assert not [f for f in found.inputFiles() if folder in f]
    assert {tuple(r.path): r.n_long + r.n_double for r in found.collect()}[("a", "b", "c")] == 50


def test_documents_that_nest_too_deep(spark):
    def nested(levels):
        return '{"a":' * levels + "1" + "}" * levels

    assert fields(spark, [nested(inference.MOST_LEVELS - 1)]).count() == inference.MOST_LEVELS
    with pytest.raises(ValueError, match="deeper"):
        fields(spark, [nested(inference.MOST_LEVELS)])


def test_payload_schema_keeps_files_of_one_run_at_a_time(spark, small, monkeypatch, tmp_path):
    """When a run is written no other is there, and none afterwards."""
    from crivo.plans import queries

    write, there = queries.files.write_payloads, []

    def files():
        return [p for p in tmp_path.rglob("*.json*") if not p.name.startswith(".")]

    def watched(*args, **options):
        there.append(len(files()))
        write(*args, **options)
        there.append(len(files()) > 0)

    monkeypatch.setattr(queries, "fresh_path", lambda spark, name: f"{tmp_path}/{name}-{len(there)}")
    monkeypatch.setattr(queries.files, "write_payloads", watched)
    rows = {r.path: r for r in queries.payload_schema(spark, small).collect()}
    assert there == [0, True, 0, True] and not files()
    both = 2 * spark.read.parquet(f"{small}/orders.parquet").count()
    assert rows[""].n_object == both and rows["request.regiao"].n_string <= both // 2
    version = rows["versao_modelo"]
    assert (version.n_long, version.n_string, version.conflict) == (both // 2, both // 2, True)
