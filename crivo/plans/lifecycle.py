"""The model's life in steps: features, training, promotion, scoring, audit.

Only tables and the registry pass between the steps, so each can run as a job
of its own. The driver holds vocabularies, signatures, alias rows and metrics,
never rows of data.
"""

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo import schema
from crivo.operators import audit as auditing
from crivo.operators import promotion, traces
from crivo.operators.encode import matrix_signature, vocabulary
from crivo.operators.forest import CHALLENGER, CHAMPION, ForestParams, fit_forest, is_large, score_forest
from crivo.operators.metrics import evaluate
from crivo.operators.registry import Registry
from crivo.operators.scoring import (
    first_contracts,
    predictions,
    predictions_with_probability,
    responses,
)
from crivo.operators.split import mark_test_rows, split_cuts
from crivo.sources import payloads as files
from crivo.sources.tables import ensure_namespace, replace_table, staged

# Tables and model of a namespace, names of the training runs.
FEATURES = "features_contratos"
PREDICTIONS = "predicoes_inadimplencia"
MODEL = "modelo_inadimplencia"
PAYLOAD_FOLDER = "payloads_inferencia"
TRACE_PREFIX = "traces_inferencia"
PAYLOAD_TRACE_PREFIX = "traces_payload"
CHAMPION_RUN = "champion_rf_100"
CHALLENGER_RUN = "challenger_rf_300_d8"
EXAMPLE_ROWS = 3
POINT_ROWS = 5


@dataclass
class Workspace:
    """Where one deployment keeps its tables, models and payloads."""

    spark: SparkSession
    namespace: str
    folder: str
    registry: Registry = field(init=False)

    def __post_init__(self):
        self.folder = self.folder.rstrip("/")
        ensure_namespace(self.spark, self.namespace, f"{self.folder}/tables")
        self.registry = Registry(
            self.spark, f"{self.folder}/registry", f"{self.namespace}.{MODEL}"
        )

    def table(self, name: str) -> str:
        return f"{self.namespace}.{name}"

    @property
    def payload_folder(self) -> str:
        return f"{self.folder}/{PAYLOAD_FOLDER}"


def save_features(ws: Workspace, features: DataFrame) -> DataFrame:
    """Replace the feature table."""
    return replace_table(features, ws.table(FEATURES))


def split_features(ws: Workspace) -> DataFrame:
    """The feature table with its split, the same in every step."""
    features = ws.spark.table(ws.table(FEATURES))
    return mark_test_rows(features, staged(split_cuts(features), "cuts"))


def train_and_register(
    ws: Workspace,
    champion: ForestParams = CHAMPION,
    challenger: ForestParams = CHALLENGER,
    keep_champion: bool = False,
) -> dict[str, int]:
    """Fit both candidates, log and register them, and point the aliases at
    them. ``keep_champion`` leaves an existing champion alias where it is."""
    split = split_features(ws)
    signature = matrix_signature(split, vocabulary(split))
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    versions = {}
    candidates = (
        (promotion.CHAMPION, CHAMPION_RUN, champion),
        (promotion.CHALLENGER, CHALLENGER_RUN, challenger),
    )
    for alias, run_name, params in candidates:
        forest = fit_forest(train, signature, params)
        scored = score_forest(test, forest, signature, keep=[schema.LABEL], whole_table=True)
        measured = evaluate(scored.withColumn("run", F.lit(run_name)), by="run").first()
        example = first_contracts(test, EXAMPLE_ROWS).select(*schema.REQUEST.fieldNames())
        version = ws.registry.register(forest, signature, example)
        ws.registry.log_run(
            run_id=f"{run_name}-v{version}",
            name=run_name,
            params={
                "n_estimators": params.num_trees,
                "max_depth": params.max_depth,
                "max_rows": params.max_rows,
            },
            metrics={"auc": measured.auc, "accuracy": measured.accuracy, "f1": measured.f1},
        )
        versions[alias] = version
    if not (keep_champion and ws.registry.version_of(promotion.CHAMPION)):
        ws.registry.set_alias(promotion.CHAMPION, versions[promotion.CHAMPION])
    ws.registry.set_alias(promotion.CHALLENGER, versions[promotion.CHALLENGER])
    return versions


def evaluate_and_promote(
    ws: Workspace, description: str | None = None, tags: dict[str, str] | None = None
) -> DataFrame:
    """Compare the aliases on the holdout, promote if due, describe the model.
    Returns the one-row decision."""
    test = split_features(ws).where("is_test")
    aliases = [promotion.CHAMPION, promotion.CHALLENGER]
    present = [a for a in aliases if ws.registry.version_of(a) is not None]
    scored = test
    for alias in present:
        model = ws.registry.load(alias)
        scored = score_forest(scored, model.forest, model.signature, keep=scored.columns, whole_table=True)
        scored = scored.withColumnRenamed("prob", f"prob_{alias}").drop(
            "classe_modelo", "classe_limiar"
        )
    pairs = F.array(
        *[F.struct(F.lit(a).alias("alias"), F.col(f"prob_{a}").alias("prob")) for a in present]
    )
    stacked = scored.select(schema.LABEL, F.explode(pairs).alias("pair")).select(
        schema.LABEL, "pair.alias", "pair.prob"
    )
    decided = staged(promotion.decide(promotion.compare(stacked)), "decision")
    promotion.apply_decision(ws.registry, decided.first().decision)
    if description is not None:
        ws.registry.set_description(description)
    for key, value in (tags or {}).items():
        ws.registry.set_tag(key, value)
    return decided


def batch_inference(
    ws: Workspace,
    with_probability: bool = False,
    scored_at: datetime.datetime | None = None,
) -> DataFrame:
    """Score the feature table with the champion and replace the predictions."""
    model = ws.registry.load(promotion.CHAMPION)
    features = ws.spark.table(ws.table(FEATURES))
    scored = score_forest(features, model.forest, model.signature, keep=[schema.KEY], whole_table=True)
    shape = predictions_with_probability if with_probability else predictions
    rows = shape(scored, model.name, model.version, scored_at=scored_at)
    return replace_table(rows, ws.table(PREDICTIONS))


def answer(ws: Workspace, contracts: DataFrame) -> tuple[DataFrame, int]:
    """Class and probability for contracts, with their features, and the
    version that gave them."""
    model = ws.registry.load(promotion.CHAMPION)
    keep = [schema.KEY, *schema.REQUEST.fieldNames()]
    scored = score_forest(contracts, model.forest, model.signature, keep, whole_table=is_large(model.forest))
    return responses(scored, keep), model.version


def point_scoring(
    ws: Workspace,
    contracts: DataFrame,
    run_id: str,
    name: str = traces.STORED_SPAN,
    prefix: str = TRACE_PREFIX,
    with_payload: bool = False,
    buckets: int = files.BUCKETS,
) -> DataFrame:
    """Score contracts, store a span for each and, if asked, the payload.

    Repeated with the same ``run_id``, it replaces what the run stored before.
    Many contracts want more ``buckets`` of payloads (``payloads.buckets_for``).
    """
    started = datetime.datetime.now(datetime.timezone.utc)
    answered, version = answer(ws, contracts)
    model = ws.registry.model
    if with_payload:
        # Written once and read twice, so spans and payloads agree.
        answered = staged(
            files.with_payloads(answered, model, version, run_id, ws.payload_folder, buckets),
            "answered",
        )
        files.write_payloads(answered, ws.payload_folder, run_id)
    new = traces.spans(answered, name, model, version, run_id, started)
    traces.store_spans(new, ws.namespace, prefix, run_id)
    return answered.select(schema.KEY, *schema.RESPONSE.fieldNames())


def first_of_features(ws: Workspace, k: int = POINT_ROWS) -> DataFrame:
    return first_contracts(ws.spark.table(ws.table(FEATURES)), k)


def audit_payloads(ws: Workspace, prefix: str = PAYLOAD_TRACE_PREFIX) -> DataFrame:
    """Spans of the payload scoring joined to what they refer to."""
    stored = ws.spark.table(traces.span_table_name(ws.namespace, prefix))
    references = traces.payload_references(stored, keep=("trace_id",))
    return auditing.audit(references, files.read_payloads(ws.spark, ws.payload_folder))


def run_all(
    ws: Workspace,
    features: DataFrame,
    champion: ForestParams = CHAMPION,
    challenger: ForestParams = CHALLENGER,
    scored_at: datetime.datetime | None = None,
) -> DataFrame:
    """Features, training, promotion and batch scoring in a row; returns the
    predictions."""
    save_features(ws, features)
    train_and_register(ws, champion, challenger)
    evaluate_and_promote(ws)
    return batch_inference(ws, scored_at=scored_at)
