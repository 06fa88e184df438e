"""Full request/response payloads as JSON files, found again by URI."""

import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo import schema
from crivo.functions.uri import normalise_uri

BUCKETS = 64
# Payloads that a lookup by URI may have to read: one bucket.
ROWS_PER_BUCKET = 250_000
CORRUPT = "_corrupt_record"
_BUCKET = "payload_bucket"
_RUN = "payload_run"
_KEEP_NULLS = {"ignoreNullFields": "false"}


def payload_id(key: Column, version: int, run_id: str) -> Column:
    """32 hex digits that a repeated run gives again."""
    text = F.concat_ws("|", key.cast("string"), F.lit(str(version)), F.lit(run_id))
    return F.md5(text.cast("binary"))


def buckets_for(n_rows: int) -> int:
    """Buckets that keep each of them small enough to read for one payload."""
    return max(BUCKETS, -(-n_rows // ROWS_PER_BUCKET))


def payload_bucket(identity: Column, buckets: int) -> Column:
    number = F.conv(F.substring(identity, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")


def payload_uri(
    key: Column, version: int, run_id: str, uri_base: str, buckets: int = BUCKETS
) -> Column:
    """The name of a payload. The bucket in it tells which folder to look in."""
    identity = payload_id(key, version, run_id)
    return F.concat(
        F.lit(f"{uri_base.rstrip('/')}/{_BUCKET}="),
        payload_bucket(identity, buckets).cast("string"),
        F.lit("/"),
        key.cast("string"),
        F.lit("_"),
        identity,
        F.lit(".json"),
    )


def payload_json(payload: Column) -> Column:
    return F.to_json(payload, _KEEP_NULLS)


def with_payloads(
    answered: DataFrame,
    model: str,
    version: int,
    run_id: str,
    uri_base: str,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add the payload, its size in bytes and its URI to answered contracts.

    The URI is a name, not a file: many payloads share a file, and each carries
    its URI inside. The bucket in the URI tells which folder to look in.
    """
    key = F.col(schema.KEY)
    payload = F.struct(
        key.alias("id_contrato"),
        F.struct(*schema.REQUEST.fieldNames()).alias("request"),
        F.struct(
            F.col("inadimplente").cast("bigint").alias("inadimplente"), F.col("prob")
        ).alias("response"),
        F.lit(model).alias("modelo"),
        F.lit(str(version)).alias("versao_modelo"),
    )
    return (
        answered.withColumn("payload", payload)
        .withColumn(_BUCKET, payload_bucket(payload_id(key, version, run_id), buckets))
        .withColumn("payload_uri", payload_uri(key, version, run_id, uri_base, buckets))
        .withColumn("payload_bytes", F.octet_length(payload_json(F.col("payload"))).cast("bigint"))
    )


def write_payloads(
    with_payload: DataFrame, base: str, run_id: str | None = None, compression: str = "none"
) -> None:
    """Write the payloads as JSON lines, one folder per bucket.

    With a ``run_id`` they go below a folder of the run, in place of what an
    earlier attempt left there; without one, ``base`` must not exist yet.

    The rebalance gathers a bucket's rows into few files, and splits a bucket
    that outgrows one task.
    """
    folder, mode = base, "errorifexists"
    if run_id is not None:
        folder, mode = f"{base}/{_RUN}={quote(run_id, safe='')}", "overwrite"
    (
        with_payload.select("payload.*", "payload_uri", _BUCKET)
        .hint("rebalance", F.col(_BUCKET))
        .write.mode(mode)
        .options(**_KEEP_NULLS, compression=compression)
        .partitionBy(_BUCKET)
        .json(folder)
    )


def read_payloads(spark: SparkSession, base: str) -> DataFrame:
    """Payloads this engine wrote, each with its URI. Text that is no payload
    comes as a row with ``_corrupt_record`` set."""
    extra = [
        T.StructField("payload_uri", T.StringType()),
        T.StructField(_BUCKET, T.IntegerType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
    found = _read_json(spark, base, extra, multi_line=False)
    return found.withColumn("file_path", F.col("_metadata.file_path")).drop(_RUN)


def read_payload_files(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """Payloads kept one per file by someone else: the URI is the file's path.
    Indented files need ``multi_line``."""
    extra = [T.StructField(CORRUPT, T.StringType())]
    return _read_json(spark, folder, extra, multi_line).withColumn(
        "payload_uri", normalise_uri(F.col("_metadata.file_path"), encoded=True)
    )


def list_payload_files(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            normalise_uri(F.col("path"), encoded=False).alias("path"),
            "length",
            "modificationTime",
        )
    )


def payloads_at(payloads: DataFrame, uris: list[str]) -> DataFrame:
    """The payloads under the given URIs; other buckets are not read."""
    found = payloads.where(F.col("payload_uri").isin(*uris))
    buckets = [re.search(rf"/{_BUCKET}=(\d+)/", uri) for uri in uris]
    if _BUCKET in payloads.columns and all(buckets):
        found = found.where(F.col(_BUCKET).isin(*sorted({int(m.group(1)) for m in buckets})))
    return found


def rebuilt(payloads: DataFrame) -> DataFrame:
    """Each payload as the struct it was written from, and as JSON text."""
    whole = F.struct(*schema.PAYLOAD.fieldNames())
    text = payload_json(whole)
    return payloads.select("payload_uri", whole.alias("payload"), text.alias("json"))


def _read_json(
    spark: SparkSession, folder: str, extra: list[T.StructField], multi_line: bool
) -> DataFrame:
    return (
        spark.read.schema(T.StructType(schema.PAYLOAD.fields + extra))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", str(multi_line).lower())
        .json(folder)
    )
