"""Join trace spans back to the payloads they refer to.

The columns of an audit are fixed values: its readers know them by name.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.operators.skew import HOT_ROWS, SALTS, hot_keys, salted_left_join

_HASH = "_uri_hash"

# Kinds of rows of a whole audit.
MATCHED = "matched"
SPAN_ONLY = "span_without_payload"
PAYLOAD_ONLY = "payload_without_span"


def audit(references: DataFrame, payloads: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every reference with its payload.

    A reference without payload keeps its row; ``id_contrato`` is the
    payload's, so it is NULL there. A URI that more than ``hot_rows`` spans
    share is spread over tasks by the other columns of the reference, such as
    the trace: values of the row, so that a task run again sends it the same
    way. URIs are counted by an 8-byte hash, which moves far less than the
    texts would.
    """
    refs = references.withColumn(_HASH, F.xxhash64("payload_uri"))
    kept = payloads.select("payload_uri", "id_contrato", "versao_modelo", "response")
    kept = kept.withColumn(_HASH, F.xxhash64("payload_uri"))
    hot = hot_keys(refs, _HASH, hot_rows)
    spread = F.struct(*references.columns)
    joined = salted_left_join(refs, kept, ["payload_uri", _HASH], _HASH, spread, hot)
    return joined.select(
        "id_contrato",
        "versao_modelo",
        "payload_bytes",
        F.col("response.inadimplente").alias("inadimplente"),
        F.col("response.prob").alias("prob"),
        "payload_uri",
    )


def audit_all(references: DataFrame, payloads: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The audit and the orphans of both sides from one full join: every
    reference with its payload, and every payload that no reference names, told
    apart by ``kind``.

    The references of a URI that very many spans share are spread over salts,
    each of which gets a copy of the payload. A copy that meets no reference is
    no orphan, since such a URI has references.
    """
    refs = references.withColumn(_HASH, F.xxhash64("payload_uri"))
    hot = hot_keys(refs, _HASH, hot_rows)
    kept = payloads.select(
        "payload_uri", "id_contrato", "versao_modelo", "response", F.lit(True).alias("_stored")
    ).withColumn(_HASH, F.xxhash64("payload_uri"))
    refs = refs.withColumn("_named", F.lit(True))
    none, on = F.lit(0).cast("bigint"), ["payload_uri", _HASH, "_salt"]
    if hot is None:
        refs, kept = refs.withColumn("_salt", none), kept.withColumn("_salt", none)
    else:
        marked = F.broadcast(hot.select(F.col(_HASH), F.lit(True).alias("_hot")))
        salt = F.pmod(F.xxhash64(*references.columns), F.lit(SALTS).cast("bigint"))
        salts = F.sequence(none, F.lit(SALTS - 1).cast("bigint"))
        refs = refs.join(marked, _HASH, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(none))
        kept = kept.join(marked, _HASH, "left").withColumn(
            "_salt", F.explode(F.when(F.col("_hot"), salts).otherwise(F.array(none)))
        )
        refs = refs.drop("_hot")
    # A null URI names nothing, on either side.
    joined = refs.join(kept, on, "full")
    if hot is not None:
        joined = joined.where(F.col("_named").isNotNull() | F.col("_hot").isNull())
    kind = F.when(F.col("_named").isNull(), PAYLOAD_ONLY).when(F.col("_stored").isNull(), SPAN_ONLY)
    return joined.select(
        kind.otherwise(MATCHED).alias("kind"),
        "id_contrato",
        "versao_modelo",
        "payload_bytes",
        F.col("response.inadimplente").alias("inadimplente"),
        F.col("response.prob").alias("prob"),
        "payload_uri",
    )


def references_without_payload(
    references: DataFrame, payloads: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """References that name no stored payload, however many name the same."""
    refs = references.withColumn(_HASH, F.xxhash64("payload_uri"))
    stored = _uris(payloads).withColumn(_HASH, F.xxhash64("payload_uri")).withColumn("_stored", F.lit(True))
    hot = hot_keys(refs, _HASH, hot_rows)
    spread = F.struct(*references.columns)
    joined = salted_left_join(refs, stored, ["payload_uri", _HASH], _HASH, spread, hot)
    return joined.where(F.col("_stored").isNull()).select(*references.columns)


def payloads_without_reference(references: DataFrame, payloads: DataFrame) -> DataFrame:
    return payloads.join(_uris(references), "payload_uri", "left_anti")


def payloads_with_reference(references: DataFrame, payloads: DataFrame) -> DataFrame:
    return payloads.join(_uris(references), "payload_uri", "left_semi")


def _uris(df: DataFrame) -> DataFrame:
    """Each URI once; copies already fold on the map side."""
    return df.select("payload_uri").distinct()
