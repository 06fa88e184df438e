"""Score contracts one by one as they arrive, with a span for each.

Scoring keeps no state between rows, so the stream needs neither watermark nor
state store. A batch that is run again after a failure writes the same files
again: the output folder is named after the batch.
"""

import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crivo import schema
from crivo.operators import traces
from crivo.operators.forest import is_large, score_forest
from crivo.operators.registry import LoadedModel
from crivo.operators.scoring import responses


CORRUPT = "_corrupt_record"


def arriving_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts as JSON lines, dropped into a folder. A line that is no contract
    comes with its text in ``_corrupt_record``."""
    fields = [schema.FEATURE_TABLE[schema.KEY], *schema.REQUEST.fields, T.StructField(CORRUPT, T.StringType())]
    return (
        spark.readStream.schema(T.StructType(fields))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(folder)
    )


def can_be_scored(contracts: DataFrame) -> Column:
    """Lines that were contracts and hold every whole number: those have no
    missing value in a signature."""
    fields = [schema.FEATURE_TABLE[schema.KEY], *schema.REQUEST.fields]
    whole = [F.col(f.name).isNotNull() for f in fields if isinstance(f.dataType, T.LongType)]
    if CORRUPT in contracts.columns:
        whole.append(F.col(CORRUPT).isNull())
    return reduce(and_, whole)


def answer_arrivals(contracts: DataFrame, model: LoadedModel) -> DataFrame:
    keep = [schema.KEY, *schema.REQUEST.fieldNames()]
    scored = score_forest(contracts, model.forest, model.signature, keep, whole_table=is_large(model.forest))
    return responses(scored, keep)


def store_spans_of_arrivals(
    contracts: DataFrame,
    model: LoadedModel,
    output: str,
    checkpoint: str,
    name: str = traces.STORED_SPAN,
    rejected: str | None = None,
) -> StreamingQuery:
    """Start a query that takes what has arrived and stops.

    What cannot be scored does not stop it: it goes to the folder ``rejected``
    (``<output>_rejected`` if none is named), with the text of lines that could
    not be read in ``line``."""
    aside = rejected or f"{output.rstrip('/')}_rejected"

    def write(batch: DataFrame, batch_id: int) -> None:
        started = datetime.datetime.now(datetime.timezone.utc)
        fit = can_be_scored(batch)
        answered = answer_arrivals(batch.where(fit).drop(CORRUPT), model)
        spans = traces.spans(
            answered, name, model.name, model.version, f"stream-{batch_id}", started
        )
        spans.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        lost = batch.where(~fit).withColumnRenamed(CORRUPT, "line")
        lost.write.mode("overwrite").json(f"{aside}/batch={batch_id}")

    return (
        contracts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
