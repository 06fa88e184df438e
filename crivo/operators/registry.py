"""Model registry: append-only tables, and views folded from them.

Every change is one row of ``registry_events`` with a sequence number that
grows per registry. The state of a model is what the latest row of each key
says, so folding does not depend on the order rows are stored in.
"""

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.operators.encode import SignatureColumn, signature_table
from crivo.operators.skew import HOT_ROWS, hot_keys, key_levels, position_in_group

EVENTS = (
    "model string, seq bigint, op string, key string, version int, value string, actor string"
)
RUNS = "run_id string, run_name string, kind string, key string, value string"
SIGNATURES = (
    "model string, version int, pos int, name string, type string, source string, category string"
)

REGISTER = "register"
SET_ALIAS = "set_alias"
DELETE_ALIAS = "delete_alias"
SET_TAG = "set_tag"
SET_DESCRIPTION = "set_description"


def fold_aliases(events: DataFrame) -> DataFrame:
    """Current version of every alias; a deleted alias is gone, its version
    is not."""
    latest = (
        events.where(F.col("op").isin(SET_ALIAS, DELETE_ALIAS))
        .groupBy("model", F.col("key").alias("alias"))
        .agg(F.max_by(F.struct("op", "version"), "seq").alias("last"))
    )
    return latest.where(F.col("last.op") == SET_ALIAS).select(
        "model", "alias", F.col("last.version").alias("version")
    )


def fold_metadata(events: DataFrame) -> DataFrame:
    """Current tags and description: (model, kind, key, value)."""
    return (
        events.where(F.col("op").isin(SET_TAG, SET_DESCRIPTION))
        .select(
            "model",
            F.when(F.col("op") == SET_TAG, "tag").otherwise("description").alias("kind"),
            F.when(F.col("op") == SET_TAG, F.col("key")).otherwise("").alias("key"),
            "value",
            "seq",
        )
        .groupBy("model", "kind", "key")
        .agg(F.max_by("value", "seq").alias("value"))
    )


def fold_versions(events: DataFrame) -> DataFrame:
    """Versions that were registered, and by whom."""
    return events.where(F.col("op") == REGISTER).select(
        "model", "version", F.col("value").alias("path"), "actor", "seq"
    )


def fold_paths(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """Where the model of each alias lies: (model, alias, version, path). The path
    is NULL where an alias names a version that nobody registered."""
    return aliases.join(
        versions.select("model", "version", "path"), ["model", "version"], "left"
    ).select("model", "alias", "version", "path")


def number_versions(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Give register events without a number the next one of their model, in
    sequence order."""
    registered = events.where(F.col("op") == REGISTER)
    hot = hot_keys(registered, "model", hot_rows)
    numbered = position_in_group(
        registered, "model", ["seq"], key_levels(F.col("seq")), "_before", hot
    )
    return numbered.withColumn("version", (F.col("_before") + 1).cast("int")).drop("_before")


def duplicate_sequence_numbers(events: DataFrame) -> DataFrame:
    """Sequence numbers used more than once: two writers were at work."""
    return (
        events.groupBy("model", "seq")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def run_values(runs: DataFrame, kind: str) -> DataFrame:
    return runs.where(F.col("kind") == kind).select("run_id", "run_name", "key", "value")


@dataclass(frozen=True)
class LoadedModel:
    name: str
    version: int
    forest: RandomForestClassificationModel
    signature: list[SignatureColumn]


class Registry:
    """One model's registry in a folder all executors share.

    Holds a handful of rows per version. Versions and events are numbered from
    one without a gap. One writer at a time: parquet has no compare-and-swap,
    so two writers could take the same number; the next call then raises.
    """

    def __init__(self, spark: SparkSession, folder: str, model: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self.model = model

    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS)

    def log_run(self, run_id: str, name: str, params: dict, metrics: dict) -> None:
        rows = [
            (run_id, name, kind, key, str(value))
            for kind, values in (("param", params), ("metric", metrics))
            for key, value in values.items()
        ]
        self._append("runs", self._spark.createDataFrame(rows, RUNS))

    def register(
        self,
        forest: RandomForestClassificationModel,
        signature: list[SignatureColumn],
        input_example: DataFrame | None = None,
    ) -> int:
        """Save the model under the next version number and return it.

        Model, signature and example go to a folder of their own, and the event
        that names it comes last: an attempt that fails before leaves no version
        and nothing that a later one could read or overwrite.
        """
        facts = self._facts()
        version = facts.n_versions + 1
        path = f"{self._folder}/models/{self.model}/v={version}-{uuid.uuid4().hex}"
        forest.save(f"{path}/forest")
        if input_example is not None:
            input_example.write.json(f"{path}/input_example")
        table = signature_table(self._spark, self.model, version, signature)
        table.coalesce(1).write.parquet(f"{path}/signature")
        self._record(facts.last_seq, REGISTER, version=version, value=path)
        return version

    def set_alias(self, alias: str, version: int) -> None:
        facts = self._facts()
        if not 1 <= version <= facts.n_versions:
            raise ValueError(f"{self.model} has no version {version}")
        self._record(facts.last_seq, SET_ALIAS, key=alias, version=version)

    def delete_alias(self, alias: str) -> None:
        self._record(self._facts().last_seq, DELETE_ALIAS, key=alias)

    def set_tag(self, key: str, value: str) -> None:
        self._record(self._facts().last_seq, SET_TAG, key=key, value=value)

    def set_description(self, text: str) -> None:
        self._record(self._facts().last_seq, SET_DESCRIPTION, value=text)

    def version_of(self, alias: str) -> int | None:
        return self._facts(alias).alias_version

    def load(self, alias: str) -> LoadedModel:
        """The model an alias points to, with the signature it was saved with."""
        version = self.version_of(alias)
        if version is None:
            raise ValueError(f"{self.model} has no alias {alias}")
        events = self.events().where(F.col("model") == self.model)
        paths = fold_paths(fold_aliases(events), fold_versions(events))
        path = paths.where(F.col("alias") == alias).first().path
        rows = self._spark.read.schema(SIGNATURES).parquet(f"{path}/signature").collect()
        return LoadedModel(
            self.model,
            version,
            RandomForestClassificationModel.load(f"{path}/forest"),
            [
                SignatureColumn(r.name, r.type, r.source, r.category)
                for r in sorted(rows, key=lambda r: r.pos)
            ],
        )

    def _facts(self, alias: str | None = None):
        """What the next change depends on, in one pass over the events."""
        of_alias = F.col("op").isin(SET_ALIAS, DELETE_ALIAS) & (F.col("key") == F.lit(alias))
        facts = (
            self.events()
            .where(F.col("model") == self.model)
            .agg(
                F.coalesce(F.max("seq"), F.lit(0)).alias("last_seq"),
                F.count(F.lit(1)).alias("n_events"),
                F.count_if(F.col("op") == REGISTER).alias("n_versions"),
                # A deletion carries no version, so the latest row decides.
                F.max(F.when(of_alias, F.struct("seq", "version")))["version"].alias(
                    "alias_version"
                ),
            )
            .first()
        )
        if facts.last_seq != facts.n_events:
            raise ValueError(f"events of {self.model} are not numbered 1 to n: two writers?")
        return facts

    def _record(self, last_seq: int, op: str, key=None, version=None, value=None) -> None:
        row = [(self.model, last_seq + 1, op, key, version, value, None)]
        event = self._spark.createDataFrame(row, EVENTS)
        self._append("events", event.withColumn("actor", F.current_user()))

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self._folder}/{table}")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self._spark.read.schema(schema).parquet(f"{self._folder}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], schema)
