import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from crivo import schema
from crivo.operators import audit, scoring, traces
from crivo.sources import payloads as files

AT = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def answered(spark, features):
    from crivo.sources.tables import staged

    scored = features.withColumn("prob", F.lit(0.123456))
    scored = scored.withColumn(
        "tipo_equipamento", F.when(F.col("id_contrato") != 3, F.lit("São João"))
    )
    keep = [schema.KEY, *schema.REQUEST.fieldNames()]
    return staged(
        files.with_payloads(scoring.responses(scored, keep), "m", 4, "run", "/lake/p", 8),
        "answered",
    )


@pytest.fixture(scope="module")
def written(spark, answered):
    from crivo.session import fresh_path

    path = fresh_path(spark, "payloads")
    files.write_payloads(answered, path)
    return path


def test_bytes_are_those_of_compact_utf8_json(answered):
    row = answered.where("id_contrato = 5").first()
    document = row.payload.asDict(recursive=True)
    text = json.dumps(document, ensure_ascii=False, separators=(",", ":"))
    assert "São" in text and row.payload_bytes == len(text.encode())


def test_missing_fields_are_kept(answered):
    text = answered.where("id_contrato = 3").select(files.payload_json(F.col("payload"))).first()[0]
    assert json.loads(text)["request"]["tipo_equipamento"] is None


def test_names_repeat_with_the_run_only(spark):
    ids = spark.range(3)
    names = [
        {r[0] for r in ids.select(files.payload_id(F.col("id"), v, run)).collect()}
        for v, run in ((1, "a"), (1, "a"), (2, "a"), (1, "b"))
    ]
    assert names[0] == names[1] and not names[0] & names[2] and not names[0] & names[3]


def test_what_is_written_is_read(spark, answered, written):
    payloads = files.read_payloads(spark, written)
    assert payloads.select("payload_uri", "_corrupt_record").where(
        "_corrupt_record IS NOT NULL"
    ).collect() == []
    read = payloads.select(*schema.PAYLOAD.fieldNames(), "payload_uri")
    sent = answered.select("payload.*", "payload_uri")
    assert sorted(map(str, read.collect())) == sorted(map(str, sent.collect()))


def test_one_file_per_bucket_and_no_stray_folder(written):
    folders = [f for f in os.listdir(written) if f.startswith("payload_bucket=")]
    assert len(folders) == 8
    for folder in folders:
        assert len([f for f in os.listdir(f"{written}/{folder}") if f.endswith(".json")]) == 1


def test_lookup_reads_the_buckets_of_its_uris(spark, answered, written):
    row = answered.where("id_contrato = 7").first()
    found = files.payloads_at(files.read_payloads(spark, written), [row.payload_uri])
    assert f"payload_bucket#" in found._jdf.queryExecution().executedPlan().toString()
    assert f"= {row.payload_bucket})" in found._jdf.queryExecution().executedPlan().toString()
    rebuilt = files.rebuilt(found).first()
    assert rebuilt.payload == row.payload
    again = spark.range(1).select(F.from_json(F.lit(rebuilt.json), schema.PAYLOAD).alias("p"))
    assert again.first().p == row.payload


def test_listing(spark, written):
    rows = files.list_payload_files(spark, written).collect()
    assert len(rows) == 8
    for row in rows:
        assert os.path.getsize(row.path) == row.length


def one_per_file(folder, documents):
    os.makedirs(folder)
    for name, text in documents.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)


def document(key):
    return {"id_contrato": key, "response": {"inadimplente": 1, "prob": 0.5}, "modelo": "m",
            "versao_modelo": "1"}


def test_folder_with_awkward_name(spark, tmp_path):
    folder = str(tmp_path / "a b+c%d")
    one_per_file(folder, {f"{k}.json": json.dumps(document(k)) for k in (1, 2)})
    refs = spark.createDataFrame(
        [(f"{folder}/1.json", 1, 10), (f"{folder}/2.json", 2, 10), (f"{folder}/3.json", 3, 10)],
        "payload_uri string, id_contrato_trace long, payload_bytes long",
    )
    payloads = files.read_payload_files(spark, folder)
    rows = audit.audit(refs, payloads).orderBy("payload_uri").collect()
    assert [r.id_contrato for r in rows] == [1, 2, None]
    listed = {r.path for r in files.list_payload_files(spark, folder).collect()}
    assert listed == {f"{folder}/1.json", f"{folder}/2.json"}


def test_indented_and_truncated_files(spark, tmp_path):
    folder = str(tmp_path / "mixed")
    one_per_file(
        folder,
        {"1.json": json.dumps(document(1), indent=2), "2.json": json.dumps(document(2))[:-5]},
    )
    rows = files.read_payload_files(spark, folder, multi_line=True).collect()
    by_name = {r.payload_uri[-6:]: r for r in rows}
    assert by_name["1.json"].id_contrato == 1 and by_name["1.json"]._corrupt_record is None
    assert by_name["2.json"]._corrupt_record is not None


def test_audit_of_orphans_and_copies(spark):
    refs = spark.createDataFrame(
        [("/a", 1, 10), ("/a", 1, 10), ("/lost", 2, 10)],
        "payload_uri string, id_contrato_trace long, payload_bytes long",
    )
    payloads = spark.createDataFrame(
        [("/a", 1, "1", (1, 0.5)), ("/alone", 3, "1", (0, 0.1))],
        "payload_uri string, id_contrato long, versao_modelo string,"
        " response struct<inadimplente: long, prob: double>",
    )
    rows = audit.audit(refs, payloads).orderBy("payload_uri").collect()
    assert [(r.payload_uri, r.id_contrato, r.prob) for r in rows] == [
        ("/a", 1, 0.5), ("/a", 1, 0.5), ("/lost", None, None),
    ]
    assert [r.payload_uri for r in audit.references_without_payload(refs, payloads).collect()] == [
        "/lost"
    ]
    assert [r.payload_uri for r in audit.payloads_without_reference(refs, payloads).collect()] == [
        "/alone"
    ]


def test_span_without_payload_holds_its_input(answered):
    plain = answered.drop("payload_uri", "payload_bytes")
    span = traces.spans(plain, traces.POINT_SPAN, "m", 4, "run", AT, AT).first()
    assert span.attributes == {"modelo": "m"}
    assert json.loads(span.inputs).keys() == set(schema.REQUEST.fieldNames())
    assert json.loads(span.outputs) == {"inadimplente": 0, "prob": 0.1235}


def test_span_with_payload_refers_to_it(answered):
    span = traces.spans(answered, traces.PAYLOAD_SPAN, "m", 4, "run", AT, AT).first()
    assert set(span.attributes) == set(traces.ATTRIBUTE_KEYS) and span.inputs is None


def test_missing_attribute_is_null_in_both_forms(spark):
    df = spark.sql("""SELECT map('k', '1') AS attributes, '{"k": 1}' AS text""")
    row = df.select(
        traces.attribute(df, "k"),
        traces.attribute(df, "z"),
        traces.attribute(df, "k", "text"),
        traces.attribute(df, "z", "text"),
    ).first()
    assert tuple(row) == ("1", None, "1", None)


def test_span_filter_reaches_the_folders(spark, answered):
    from crivo.session import fresh_path
    from crivo.sources.tables import ensure_namespace

    ensure_namespace(spark, "span_test", fresh_path(spark, "span_test"))
    for name in (traces.POINT_SPAN, traces.PAYLOAD_SPAN):
        new = traces.spans(answered, name, "m", 4, "run", AT, AT)
        stored = traces.store_spans(new, "span_test", "t", "run")
    refs = traces.payload_references(stored)
    plan = refs._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(name" in plan
    assert refs.count() == answered.count()
    assert traces.count_spans(stored).first().n_spans == 2 * answered.count()
