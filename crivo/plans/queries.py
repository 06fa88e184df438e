"""One query per operator, each over the whole of the given tables."""

import datetime
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions.credit import threshold_class
from crivo.functions.numeric import clip, round_half_even
from crivo.functions.uri import normalise_uri
from crivo.operators import audit, encode, generate, metrics, promotion, registry, scoring, traces
from crivo.operators import split as splitting
from crivo.operators.forest import CHALLENGER, CHAMPION, ForestParams, class_weights, fit_forest, score_forest
from crivo.plans import lifecycle
from crivo.session import fresh_path, shared_folder
from crivo.sources import inference
from crivo.sources import payloads as files
from crivo.sources.contracts import (
    contract_terms,
    feature_table,
    scored_contracts,
    with_commitment,
)
from crivo.sources.tables import (
    ensure_namespace,
    read_parquet,
    remove,
    replace_table,
    schema_report,
    scratch,
    staged,
    tables_with_prefix,
)

MODEL = "modelo_inadimplencia"
VERSION = 1
RUN = "r1"
SCORED_AT = datetime.datetime(2024, 1, 1)
URI_BASE = "/lake/payloads_inferencia"
NAMESPACE = "crivo_queries"


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Key, label and fixed scores, written once: the split reads them often."""
    columns = (schema.KEY, schema.LABEL, "prob", "prob_sem_utilizacao")
    return staged(scored_contracts(spark, folder).select(*columns), "labelled")


def _holdout_scores(spark: SparkSession, folder: str) -> DataFrame:
    test = splitting.stratified_split(_labelled(spark, folder)).where("is_test")
    scores = {promotion.CHAMPION: "prob", promotion.CHALLENGER: "prob_sem_utilizacao"}
    return metrics.stack_scores(test, scores, [schema.LABEL])


def _fixed_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts scored by the fixed scorecard, with both class rules."""
    return scored_contracts(spark, folder).select(
        schema.KEY,
        schema.LABEL,
        "prob",
        (F.col("prob") > 0.5).cast("int").alias("classe_modelo"),
        threshold_class(F.col("prob")).alias("classe_limiar"),
    )


def _answered(spark: SparkSession, folder: str) -> DataFrame:
    keep = [schema.KEY, *schema.REQUEST.fieldNames()]
    return scoring.responses(scored_contracts(spark, folder), keep)


def _with_payloads(spark: SparkSession, folder: str) -> DataFrame:
    return files.with_payloads(_answered(spark, folder), MODEL, VERSION, RUN, URI_BASE)


def _spans(with_payload: DataFrame) -> DataFrame:
    return traces.spans(
        with_payload, traces.PAYLOAD_SPAN, MODEL, VERSION, RUN, SCORED_AT, SCORED_AT
    )


def _written_payloads(with_payload: DataFrame) -> DataFrame:
    spark = with_payload.sparkSession
    path = fresh_path(spark, "payloads")
    files.write_payloads(with_payload, path)
    return files.read_payloads(spark, path)


def _namespace(spark: SparkSession, name: str = NAMESPACE) -> str:
    ensure_namespace(spark, name, f"{shared_folder(spark)}/{name}")
    return name


# Tables


def scan_features(spark: SparkSession, folder: str) -> DataFrame:
    return feature_table(spark, folder)


def feature_table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Save the feature table, then replace it by a query over itself that
    changes the schema."""
    table = f"{_namespace(spark)}.features_{uuid.uuid4().hex[:12]}"
    saved = replace_table(feature_table(spark, folder), table)
    balance = (F.col("valor_financiado") - F.col("valor_entrada")).alias("saldo")
    return replace_table(saved.select(schema.KEY, balance, "regiao", schema.LABEL), table)


def feature_schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of the feature table with their number of values."""
    features = feature_table(spark, folder)
    counts = features.agg(
        F.array(
            *[F.struct(F.lit(c).alias("name"), F.count(c).alias("n_values")) for c in features.columns]
        ).alias("columns")
    ).select(F.inline("columns"))
    return (
        schema_report(features)
        .join(counts, "name", "left")
        .select(F.col("pos").cast("bigint").alias("pos"), "name", "type", "n_values")
    )


# Features


def gen_contracts(spark: SparkSession, folder: str) -> DataFrame:
    ids = read_parquet(spark, folder, "orders").select(F.col("o_orderkey").alias(schema.KEY))
    return generate.generate(ids)


def clip_round(spark: SparkSession, folder: str) -> DataFrame:
    price, share = F.col("l_extendedprice"), F.col("l_quantity") / F.lit(7.0)
    return read_parquet(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        clip(price, 5_000.0, 60_000.0).alias("clipped"),
        round_half_even(price, -2).alias("hundreds"),
        round_half_even(price, 0).alias("whole"),
        round_half_even(share, 2).alias("cents"),
        round_half_even(share, 3).alias("mills"),
    )


def instalment(spark: SparkSession, folder: str) -> DataFrame:
    contracts = with_commitment(contract_terms(spark, folder))
    return contracts.select(schema.KEY, round_half_even(F.col("parcela"), 2).alias("parcela"))


def commitment_ratio(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.col("comprometimento")
    return with_commitment(contract_terms(spark, folder)).select(
        schema.KEY,
        round_half_even(raw, 9).alias("comprometimento"),
        round_half_even(raw, 3).alias("comprometimento_renda"),
    )


def risk_score(spark: SparkSession, folder: str) -> DataFrame:
    return scored_contracts(spark, folder).select(
        schema.KEY, round_half_even(F.col("risco"), 9).alias("risco"), "prob"
    )


def default_label(spark: SparkSession, folder: str) -> DataFrame:
    return scored_contracts(spark, folder).select(schema.KEY, schema.LABEL)


def class_rules(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed_scored(spark, folder).select(schema.KEY, "classe_limiar", "classe_modelo")


# Model matrix and split


def category_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return encode.vocabulary_table(feature_table(spark, folder))


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    features = feature_table(spark, folder)
    return encode.one_hot(features, encode.vocabulary(features), keep=[schema.KEY])


def model_signature(spark: SparkSession, folder: str) -> DataFrame:
    features = feature_table(spark, folder)
    signature = encode.matrix_signature(features, encode.vocabulary(features))
    return encode.signature_table(spark, MODEL, VERSION, signature).select("pos", "name", "type")


def align_signature(spark: SparkSession, folder: str) -> DataFrame:
    """Align to a model that takes doubles only and knows a region this table
    does not have."""
    features = feature_table(spark, folder)
    signature = [
        encode.SignatureColumn(c.name, "double" if c.source is None else c.type, c.source, c.category)
        for c in encode.matrix_signature(features, encode.vocabulary(features))
    ]
    signature.append(encode.SignatureColumn("regiao_OCEANIA", "boolean", "regiao", "OCEANIA"))
    return encode.align(features, signature, keep=[schema.KEY])


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    split = splitting.stratified_split(_labelled(spark, folder))
    return split.select(schema.KEY, schema.LABEL, "is_test")


def split_report(spark: SparkSession, folder: str) -> DataFrame:
    features = staged(feature_table(spark, folder), "features")
    width = len(encode.matrix_signature(features, encode.vocabulary(features)))
    return splitting.split_report(splitting.stratified_split(features), width)


# Metrics


def weights(spark: SparkSession, folder: str) -> DataFrame:
    return class_weights(scored_contracts(spark, folder))


def auc(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.auc(scored_contracts(spark, folder))


def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_counts(_fixed_scored(spark, folder), predicted="classe_limiar")


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_metrics(_fixed_scored(spark, folder), predicted="classe_limiar")


def default_rate(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.default_rate(scored_contracts(spark, folder))


# Registry and promotion


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of both scorecards, logged as runs and read back."""
    log = registry.Registry(spark, fresh_path(spark, "registry"), MODEL)
    for row in metrics.evaluate(_holdout_scores(spark, folder), by="alias").collect():
        measured = {"auc": row.auc, "accuracy": row.accuracy, "f1": row.f1}
        log.log_run(f"run_{row.alias}", row.alias, {"scorecard": row.alias}, measured)
    return registry.run_values(log.runs(), "metric").withColumn(
        "value", F.col("value").cast("double")
    )


def _registry_log(spark: SparkSession, folder: str) -> DataFrame:
    """A registry history out of the event stream: each event changes one of
    seven models."""
    k = F.get_json_object("props", "$.k").cast("int")
    op = (
        F.when(F.col("event_type") == "signup", registry.REGISTER)
        .when(F.col("event_type") == "click", registry.SET_ALIAS)
        .when(F.col("event_type") == "error", registry.DELETE_ALIAS)
        .when(F.col("event_type") == "view", registry.SET_TAG)
        .otherwise(registry.SET_DESCRIPTION)
    )
    events = read_parquet(spark, folder, "events").select(
        F.concat(F.lit("modelo_"), F.col("user_id") % 7).alias("model"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
        k.alias("k"),
        (F.floor("value").cast("int") + 1).alias("v"),
        F.concat(F.lit("user_"), "user_id").alias("actor"),
    )
    of_alias = F.col("op").isin(registry.SET_ALIAS, registry.DELETE_ALIAS)
    of_text = F.col("op").isin(registry.SET_TAG, registry.SET_DESCRIPTION)
    path = F.concat(F.lit("models/"), F.col("seq").cast("string"))
    k = F.col("k")
    alias = F.when(k % 2 == 0, promotion.CHAMPION).otherwise(promotion.CHALLENGER)
    tag = F.when(k % 3 == 0, "dominio").when(k % 3 == 1, "owner").otherwise("projeto")
    return events.select(
        "model",
        "seq",
        "op",
        F.when(of_alias, alias).when(F.col("op") == registry.SET_TAG, tag).alias("key"),
        F.when(F.col("op") == registry.SET_ALIAS, F.col("v")).alias("version"),
        F.when(F.col("op") == registry.REGISTER, path)
        .when(of_text, F.concat(F.lit("v"), k))
        .alias("value"),
        "actor",
    )


def registry_versions(spark: SparkSession, folder: str) -> DataFrame:
    return registry.fold_versions(registry.number_versions(_registry_log(spark, folder)))


def registry_aliases(spark: SparkSession, folder: str) -> DataFrame:
    return registry.fold_aliases(_registry_log(spark, folder))


def registry_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Where the model that each alias points to lies."""
    log = _registry_log(spark, folder)
    versions = registry.fold_versions(registry.number_versions(log))
    return registry.fold_paths(registry.fold_aliases(log), versions)


def registry_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return registry.fold_metadata(_registry_log(spark, folder))


def champion_vs_challenger(spark: SparkSession, folder: str) -> DataFrame:
    return promotion.compare(_holdout_scores(spark, folder))


def promotion_decision(spark: SparkSession, folder: str) -> DataFrame:
    """Three comparisons on the holdout: a weaker challenger, a better one and
    a copy of the champion."""
    full, partial = "prob", "prob_sem_utilizacao"
    sides = {
        "challenger_weaker": (full, partial),
        "challenger_better": (partial, full),
        "tie": (full, full),
    }
    rows = [
        F.struct(
            F.lit(name).alias("comparison"), F.lit(alias).alias("alias"), F.col(c).alias("prob")
        )
        for name, pair in sides.items()
        for alias, c in zip((promotion.CHAMPION, promotion.CHALLENGER), pair)
    ]
    test = splitting.stratified_split(_labelled(spark, folder)).where("is_test")
    stacked = test.select(schema.LABEL, F.explode(F.array(*rows)).alias("row")).select(
        schema.LABEL, "row.*"
    )
    compared = promotion.compare(stacked, by=("comparison", "alias"))
    return promotion.decide(compared, by=("comparison",))


# Forests


def _split_features(spark: SparkSession, folder: str) -> DataFrame:
    features = staged(feature_table(spark, folder), "features")
    return splitting.mark_test_rows(features, staged(splitting.split_cuts(features), "cuts"))


def _models(split: DataFrame) -> registry.Registry:
    """This application's registry of models fitted on just these rows, in the
    shared folder."""
    spark = split.sparkSession
    rows = split.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*split.columns)).alias("h")).first()
    name = f"models_{spark.sparkContext.applicationId}_{rows.n}_{rows.h or 0:x}"
    return registry.Registry(spark, f"{shared_folder(spark)}/{name}", MODEL)


def _fit_and_register(
    split: DataFrame, models: registry.Registry, run_name: str, alias: str, params: ForestParams
) -> DataFrame:
    """Fit on the training side, measure on the test side, register under the
    alias and return the metrics."""
    signature = encode.matrix_signature(split, encode.vocabulary(split))
    forest = fit_forest(split.where(~F.col("is_test")), signature, params)
    scored = score_forest(split.where("is_test"), forest, signature, keep=[schema.LABEL], whole_table=True)
    measured = staged(
        metrics.evaluate(scored.withColumn("run_name", F.lit(run_name)), by="run_name"), "measured"
    )
    models.set_alias(alias, models.register(forest, signature))
    return measured


def train_champion(spark: SparkSession, folder: str) -> DataFrame:
    split = _split_features(spark, folder)
    return _fit_and_register(split, _models(split), lifecycle.CHAMPION_RUN, promotion.CHAMPION, CHAMPION)


def train_challenger(spark: SparkSession, folder: str) -> DataFrame:
    split = _split_features(spark, folder)
    return _fit_and_register(
        split, _models(split), lifecycle.CHALLENGER_RUN, promotion.CHALLENGER, CHALLENGER
    )


def _forest_scored(spark: SparkSession, folder: str) -> DataFrame:
    """All contracts scored by the challenger that is registered for them; it is
    trained first if there is none."""
    split = _split_features(spark, folder)
    models = _models(split)
    if models.version_of(promotion.CHALLENGER) is None:
        _fit_and_register(split, models, lifecycle.CHALLENGER_RUN, promotion.CHALLENGER, CHALLENGER)
    model = models.load(promotion.CHALLENGER)
    return score_forest(split, model.forest, model.signature, keep=[schema.KEY, "is_test"], whole_table=True)


def score_proba(spark: SparkSession, folder: str) -> DataFrame:
    return _forest_scored(spark, folder).select(schema.KEY, "is_test", "prob")


def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    scored = _forest_scored(spark, folder)
    return scoring.predictions(scored, MODEL, VERSION, scored_at=SCORED_AT)


def lifecycle_run(spark: SparkSession, folder: str) -> DataFrame:
    """Features, training, promotion and batch scoring in a row; returns rows
    per predicted class and version."""
    namespace = f"crivo_{uuid.uuid4().hex[:12]}"
    ws = lifecycle.Workspace(spark, namespace, fresh_path(spark, "workspace"))
    predicted = lifecycle.run_all(ws, feature_table(spark, folder), scored_at=SCORED_AT)
    return predicted.groupBy("versao_modelo", scoring.PREDICTION).agg(
        F.count(F.lit(1)).alias("n")
    )


# Inference


def score_with_lineage(spark: SparkSession, folder: str) -> DataFrame:
    scored = _fixed_scored(spark, folder)
    return scoring.predictions(scored, MODEL, VERSION, scored_at=SCORED_AT)


def score_batch_proba(spark: SparkSession, folder: str) -> DataFrame:
    scored = _fixed_scored(spark, folder)
    return scoring.predictions_with_probability(scored, MODEL, VERSION, scored_at=SCORED_AT)


def predictions_table(spark: SparkSession, folder: str) -> DataFrame:
    table = f"{_namespace(spark)}.predicoes_{uuid.uuid4().hex[:12]}"
    return replace_table(score_with_lineage(spark, folder), table)


def prediction_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.class_distribution(score_with_lineage(spark, folder))


def sample_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.first_contracts(feature_table(spark, folder), 10)


def score_sample(spark: SparkSession, folder: str) -> DataFrame:
    first = scoring.first_contracts(
        scored_contracts(spark, folder).select(schema.KEY, "prob"), lifecycle.POINT_ROWS
    )
    return scoring.responses(first, [schema.KEY])


# Traces, payloads, audit


def trace_spans(spark: SparkSession, folder: str) -> DataFrame:
    spans = _spans(_with_payloads(spark, folder))
    answer = F.from_json("outputs", schema.RESPONSE)
    return spans.select(
        "trace_id",
        "name",
        schema.KEY,
        F.col("attributes")["modelo"].alias("modelo"),
        F.col("attributes")["versao_modelo"].alias("versao_modelo"),
        F.col("attributes")["id_contrato"].alias("id_texto"),
        F.col("attributes")["payload_bytes"].alias("bytes_texto"),
        F.col("attributes")["payload_uri"].alias("payload_uri"),
        answer["inadimplente"].alias("inadimplente"),
        answer["prob"].alias("prob"),
        "start_time",
    )


def trace_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Span tables of one prefix, with their spans. A second store whose name
    differs in one character is not listed."""
    namespace = _namespace(spark, f"crivo_{uuid.uuid4().hex[:12]}")
    prefix = lifecycle.TRACE_PREFIX
    spans = _spans(_with_payloads(spark, folder))
    traces.ensure_span_table(spark, namespace, prefix)
    traces.ensure_span_table(spark, namespace, prefix.replace("_", "x"))
    traces.store_spans(spans, namespace, prefix, "run")
    names = [r.table_name for r in tables_with_prefix(spark, namespace, prefix).collect()]
    counted = [
        traces.count_spans(spark.table(f"{namespace}.{name}")).select(
            F.lit(name).alias("table_name"), "n_spans"
        )
        for name in names
    ]
    return reduce(DataFrame.unionAll, counted)


def _event_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Events as spans, attributes both as a map and as JSON text."""
    return read_parquet(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("name"),
        F.from_json("props", "map<string,string>").alias("attributes"),
        F.col("props").alias("attributes_json"),
    )


def span_count(spark: SparkSession, folder: str) -> DataFrame:
    return traces.count_spans(_event_spans(spark, folder))


def span_refs(spark: SparkSession, folder: str) -> DataFrame:
    return traces.payload_references(_spans(_with_payloads(spark, folder)))


def span_refs_json(spark: SparkSession, folder: str) -> DataFrame:
    spans = _event_spans(spark, folder)
    return spans.select(
        "event_id",
        "name",
        traces.attribute(spans, "k").alias("from_map"),
        traces.attribute(spans, "k", "attributes_json").alias("from_json"),
    )


def uri_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Page files as four sources would report them."""
    name = F.concat(F.lit("/"), F.col("page_id").cast("string"), F.lit(".json"))

    def reported(prefix: str):
        return F.concat(F.lit(prefix), name)

    return read_parquet(spark, folder, "pages").select(
        "page_id",
        normalise_uri(reported("file:///lake/pasta%20a+b%25"), encoded=True).alias("from_file"),
        normalise_uri(reported("file:/lake/pasta a+b%"), encoded=False).alias("from_listing"),
        normalise_uri(reported("dbfs:/Volumes/lake"), encoded=True).alias("from_volume"),
        normalise_uri(reported("s3a://bucket"), encoded=True).alias("from_store"),
        normalise_uri(F.col("url"), encoded=False).alias("from_page"),
    )


def payload_write(spark: SparkSession, folder: str) -> DataFrame:
    written = _written_payloads(_with_payloads(spark, folder))
    return written.select(
        schema.KEY, "request.*", "response.*", "modelo", "versao_modelo", "payload_uri",
        "payload_bucket",
    )


def payload_read(spark: SparkSession, folder: str) -> DataFrame:
    written = _written_payloads(_with_payloads(spark, folder))
    return written.groupBy("payload_bucket").agg(
        F.count(schema.KEY).alias("n_payloads"),
        F.count(files.CORRUPT).alias("n_corrupt"),
        F.sum("response.inadimplente").alias("n_default"),
    )


def payload_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per bucket of the file they came from and bucket of their URI."""
    written = _written_payloads(_with_payloads(spark, folder))

    def bucket(uri):
        return F.regexp_extract(uri, r"/payload_bucket=(\d+)/", 1).cast("int")

    return written.groupBy(
        bucket(normalise_uri(F.col("file_path"), encoded=True)).alias("bucket_of_file"),
        bucket(F.col("payload_uri")).alias("bucket_of_uri"),
    ).agg(F.count(F.lit(1)).alias("n"))


def payload_listing(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "payloads")
    files.write_payloads(_with_payloads(spark, folder), path)
    return files.list_payload_files(spark, path)


def _references_and_payloads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Spans and payloads of all contracts."""
    answered = staged(_with_payloads(spark, folder), "answered")
    references = traces.payload_references(_spans(answered), keep=("trace_id",))
    return references, _written_payloads(answered)


def _named_payloads(rows: DataFrame, key: str, run_id: str) -> DataFrame:
    """References to the payload of a contract in a run, one for each row."""
    uri = files.payload_uri(F.col(key), VERSION, run_id, URI_BASE)
    return rows.select(
        uri.alias("payload_uri"),
        F.col(key).cast("bigint").alias("id_contrato_trace"),
        F.lit(None).cast("bigint").alias("payload_bytes"),
    )


def payload_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads behind the spans, rebuilt from their files and compared with
    what reading their JSON text again gives."""
    references, payloads = _references_and_payloads(spark, folder)
    rebuilt = files.rebuilt(audit.payloads_with_reference(references, payloads))
    again = F.from_json("json", schema.PAYLOAD)
    return rebuilt.select(
        "payload_uri",
        F.col("payload.id_contrato").alias(schema.KEY),
        F.col("payload.response.inadimplente").alias("inadimplente"),
        F.col("payload.response.prob").alias("prob"),
        F.col("payload.request.comprometimento_renda").alias("comprometimento_renda"),
        F.octet_length("json").cast("bigint").alias("payload_bytes"),
        (again == F.col("payload")).alias("same_after_rebuild"),
    )


def audit_join(spark: SparkSession, folder: str) -> DataFrame:
    """Spans with their payloads; whole numbers as text, since a frame that
    cannot hold a missing whole number would turn them into fractions."""
    audited = audit.audit(*_references_and_payloads(spark, folder))
    return audited.withColumns(
        {c: F.col(c).cast("string") for c in (schema.KEY, "inadimplente")}
    )


def audit_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Both kinds of orphans in one audit. Each line item is a span that names
    its contract's payload, so contracts without items have a payload that no
    span names; each event is a span of a run that stored no payloads."""
    items = read_parquet(spark, folder, "lineitem")
    events = read_parquet(spark, folder, "events")
    references = _named_payloads(items, "l_orderkey", RUN).unionByName(
        _named_payloads(events, "user_id", "r2")
    )
    audited = audit.audit_all(references, _written_payloads(_with_payloads(spark, folder)))
    return audited.where(F.col("kind") != audit.MATCHED).select("kind", "payload_uri")


def payload_by_uri(spark: SparkSession, folder: str) -> DataFrame:
    """The payloads of the first contracts, read back by their URIs from the
    buckets those name."""
    answered = staged(_with_payloads(spark, folder), "answered")
    uris = scoring.first_contracts(answered, lifecycle.POINT_ROWS).select("payload_uri").collect()
    found = files.payloads_at(_written_payloads(answered), [r.payload_uri for r in uris])
    return files.rebuilt(found).select(
        "payload_uri",
        F.col("payload.id_contrato").alias(schema.KEY),
        F.col("payload.response.inadimplente").alias("inadimplente"),
        F.col("payload.response.prob").alias("prob"),
        F.octet_length("json").cast("bigint").alias("payload_bytes"),
    )


def payload_folders(spark: SparkSession, folder: str) -> DataFrame:
    """The listing of written payloads, by the folder that the engine chose:
    names of files are the cluster's, their sizes follow from the payloads."""
    path = fresh_path(spark, "payloads")
    files.write_payloads(_with_payloads(spark, folder), path)
    bucket = F.regexp_extract("path", r"/payload_bucket=(\d+)/[^/]*\.json$", 1).cast("int")
    return (
        files.list_payload_files(spark, path)
        .groupBy(bucket.alias("payload_bucket"))
        .agg(F.sum("length").alias("n_bytes"))
    )


def payload_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that the payloads of two runs turn out to have. The second run
    wrote the version as a number and left out the region. Counts of the runs add
    up, so there are files of one run at a time."""
    written = _with_payloads(spark, folder).select("payload", "payload_uri", "payload_bucket")
    with scratch(spark):
        first = staged(written, "answered", result=True)
    changed = F.col("payload").withField("versao_modelo", F.lit(VERSION)).dropFields("request.regiao")
    found = _written_fields(first, RUN)
    found = inference.merged_fields(found, _written_fields(first.withColumn("payload", changed), "r2"))
    return found.withColumn("path", F.array_join("path", "."))


def _written_fields(with_payload: DataFrame, run_id: str) -> DataFrame:
    """The fields of a run's payloads, written and read as text; nothing but the
    counts stays."""
    spark = with_payload.sparkSession
    path = fresh_path(spark, "payloads")
    try:
        with scratch(spark):
            files.write_payloads(with_payload, path, run_id, compression="gzip")
            written = spark.read.option("recursiveFileLookup", "true").text(path)
            return staged(inference.json_fields(written, "value"), "fields", result=True)
    finally:
        remove(spark, path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_features": scan_features,
        "feature_table_roundtrip": feature_table_roundtrip,
        "schema_report": feature_schema_report,
        "gen_contracts": gen_contracts,
        "clip_round": clip_round,
        "instalment": instalment,
        "commitment_ratio": commitment_ratio,
        "risk_score": risk_score,
        "default_label": default_label,
        "threshold_class": class_rules,
        "category_vocabulary": category_vocabulary,
        "one_hot": one_hot,
        "model_signature": model_signature,
        "align_signature": align_signature,
        "stratified_split": stratified_split,
        "split_report": split_report,
        "class_weights": weights,
        "auc": auc,
        "confusion_counts": confusion_counts,
        "classification_metrics": classification_metrics,
        "default_rate": default_rate,
        "run_metrics": run_metrics,
        "registry_versions": registry_versions,
        "registry_aliases": registry_aliases,
        "registry_paths": registry_paths,
        "registry_metadata": registry_metadata,
        "champion_vs_challenger": champion_vs_challenger,
        "promotion_decision": promotion_decision,
        "train_champion": train_champion,
        "train_challenger": train_challenger,
        "score_proba": score_proba,
        "score_batch": score_batch,
        "lifecycle_run": lifecycle_run,
        "score_with_lineage": score_with_lineage,
        "score_batch_proba": score_batch_proba,
        "predictions_table": predictions_table,
        "prediction_distribution": prediction_distribution,
        "sample_contracts": sample_contracts,
        "score_sample": score_sample,
        "trace_spans": trace_spans,
        "trace_tables": trace_tables,
        "span_count": span_count,
        "span_refs": span_refs,
        "span_refs_json": span_refs_json,
        "uri_normalise": uri_normalise,
        "payload_write": payload_write,
        "payload_read": payload_read,
        "payload_provenance": payload_provenance,
        "payload_listing": payload_listing,
        "payload_folders": payload_folders,
        "payload_by_uri": payload_by_uri,
        "payload_schema": payload_schema,
        "payload_lookup": payload_lookup,
        "audit_join": audit_join,
        "audit_orphans": audit_orphans,
    }
