"""Trace spans: one row per scored contract."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo import schema
from crivo.sources.tables import replace_partitions

# Span names, the suffix of span tables, attribute keys.
POINT_SPAN = "scoring_inadimplencia"
STORED_SPAN = "scoring_inadimplencia_uc"
PAYLOAD_SPAN = "scoring_payload_governado"
SPAN_TABLE_SUFFIX = "_otel_spans"
ATTRIBUTE_KEYS = ("modelo", "payload_uri", "payload_bytes", "id_contrato", "versao_modelo")

SPANS = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("id_contrato", T.LongType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("inputs", T.StringType()),
        T.StructField("outputs", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
    ]
)


def trace_id(key: Column, version: int, run_id: str, name: str) -> Column:
    """The same contract, version and run give the same trace again, so a
    repeated job does not add new ones under other names."""
    return F.md5(
        F.concat_ws("|", key.cast("string"), F.lit(str(version)), F.lit(run_id), F.lit(name)).cast(
            "binary"
        )
    )


def spans(
    answered: DataFrame,
    name: str,
    model: str,
    version: int,
    run_id: str,
    started: datetime.datetime,
    ended: datetime.datetime | None = None,
) -> DataFrame:
    """Spans of answered contracts.

    ``answered`` holds the key, the response columns and the features. With
    payload columns (``payload_uri``, ``payload_bytes``) the span refers to the
    payload and leaves inputs empty; otherwise it holds the inputs itself.
    Start and end are those of the job: rows of one job have no time of their
    own.
    """
    key = F.col(schema.KEY)
    attributes = [F.lit("modelo"), F.lit(model)]
    inputs = F.to_json(F.struct(*schema.REQUEST.fieldNames()), {"ignoreNullFields": "false"})
    if "payload_uri" in answered.columns:
        attributes += [
            F.lit("payload_uri"),
            F.col("payload_uri"),
            F.lit("payload_bytes"),
            F.col("payload_bytes").cast("string"),
            F.lit("id_contrato"),
            key.cast("string"),
            F.lit("versao_modelo"),
            F.lit(str(version)),
        ]
        inputs = F.lit(None).cast("string")
    outputs = F.to_json(F.struct(*schema.RESPONSE.fieldNames()), {"ignoreNullFields": "false"})
    end = F.current_timestamp() if ended is None else F.lit(ended)
    return answered.select(
        trace_id(key, version, run_id, name).alias("trace_id"),
        F.substring(trace_id(key, version, run_id, name), 1, 16).alias("span_id"),
        F.lit(name).alias("name"),
        key.alias(schema.KEY),
        F.create_map(*attributes).alias("attributes"),
        inputs.alias("inputs"),
        outputs.alias("outputs"),
        F.lit(started).cast("timestamp").alias("start_time"),
        end.cast("timestamp").alias("end_time"),
    )


def span_table_name(namespace: str, prefix: str) -> str:
    return f"{namespace}.{prefix}{SPAN_TABLE_SUFFIX}"


def store_spans(new: DataFrame, namespace: str, prefix: str, run_id: str) -> DataFrame:
    """Put the spans of a run into the span table of a prefix, created on first
    use. Spans of one name share a folder, so a filter on the name reads only
    that. A run that is repeated replaces its spans of that name."""
    new = new.withColumn("run_id", F.lit(run_id))
    return replace_partitions(new, span_table_name(namespace, prefix), ["name", "run_id"])


def ensure_span_table(spark: SparkSession, namespace: str, prefix: str) -> DataFrame:
    table = span_table_name(namespace, prefix)
    if not spark.catalog.tableExists(table):
        store_spans(spark.createDataFrame([], SPANS), namespace, prefix, "")
    return spark.table(table)


def count_spans(stored: DataFrame) -> DataFrame:
    return stored.agg(F.count(F.lit(1)).alias("n_spans"))


def attribute(df: DataFrame, key: str, column: str = "attributes") -> Column:
    """An attribute of a span, NULL when the key is missing. Attributes are a
    map, or a JSON text in some stores."""
    if isinstance(df.schema[column].dataType, T.MapType):
        return F.col(column).getItem(key)
    return F.get_json_object(column, f"$.{key}")


def payload_references(
    stored: DataFrame, name: str = PAYLOAD_SPAN, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Payload references of the spans of one name. Attributes are texts, so
    the numbers are cast back."""
    return stored.where(F.col("name") == name).select(
        attribute(stored, "payload_uri").alias("payload_uri"),
        attribute(stored, "id_contrato").cast("bigint").alias("id_contrato_trace"),
        attribute(stored, "payload_bytes").cast("bigint").alias("payload_bytes"),
        *keep,
    )
