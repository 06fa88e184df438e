"""Random forests on the model matrix: weights, layout, fit, score."""

from dataclasses import dataclass

from pyspark.ml.classification import (
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo import schema
from crivo.functions.credit import known_class, threshold_class
from crivo.operators import trees
from crivo.operators.encode import SignatureColumn, align, quoted
from crivo.session import enable_checkpoints

# Deepest tree the library grows; stands for "no limit".
DEEPEST = 30
# Nodes that scoring sends to every task at a time.
MOST_NODES = trees.MOST_NODES
# Rows times trees that are fitted at a time: the learner keeps some eight bytes for
# each row and tree, in memory or on disk.
MOST_BAGGED = 1 << 30


@dataclass(frozen=True)
class ForestParams:
    num_trees: int
    max_depth: int = DEEPEST
    seed: int = 42
    # Rows per partition of the training layout. The fitted trees depend on the
    # layout, so it follows from the rows and not from the cluster.
    rows_per_partition: int = 500_000
    least_partitions: int = 8
    max_bins: int = 32
    # Memory for split statistics per pass; more of it means fewer passes.
    memory_mb: int = 512
    # Keep each row's node between levels, instead of sending the growing trees
    # to every task.
    cache_node_ids: bool = True
    # None fits all rows. A number fits about so many labelled ones, chosen by a hash
    # of their key, for trials; runs log it.
    max_rows: int | None = None


# The two candidates every training run fits.
CHAMPION = ForestParams(num_trees=100)
CHALLENGER = ForestParams(num_trees=300, max_depth=8)


def class_weights(
    df: DataFrame, label: str = schema.LABEL, classes=schema.CLASSES
) -> DataFrame:
    """Balanced weights n / (k * n_class), one row per class."""
    counts = (
        df.select(known_class(F.col(label), classes).alias(label))
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n_class"))
    )
    everything = Window.partitionBy()
    n, k = F.sum("n_class").over(everything), F.count(F.lit(1)).over(everything)
    weight = n.cast("double") / (k * F.col("n_class")).cast("double")
    return counts.select(label, F.col("n_class"), weight.alias("weight"))


def fit_forest(
    train: DataFrame,
    signature: list[SignatureColumn],
    params: ForestParams,
    key: str = schema.KEY,
    label: str = schema.LABEL,
) -> RandomForestClassificationModel:
    """Fit on rows that hold the features (or the matrix), the key and the
    label. Rows are laid out by key, so the same rows give the same forest however
    they arrive. Trees are fitted so many at a time that ``MOST_BAGGED`` holds, each
    time with a seed of its own; the forest is all of them. Class weights are those
    of all rows."""
    weights = class_weights(train, label).collect()
    labelled = _assemble(align(train, signature, keep=[key, label]), signature).select(
        key,
        F.col(label)
        .cast("double")
        .alias(
            "label",
            metadata={"ml_attr": {"type": "nominal", "name": "label", "vals": ["0", "1"]}},
        ),
        _weight_of(F.col(label), weights).alias("weight"),
        "features",
    )
    n_rows = sum(row.n_class for row in weights)
    if params.max_rows is not None and n_rows > params.max_rows:
        labelled = labelled.where(chosen_to_fit(F.col(key), params.max_rows / n_rows, params.seed))
        n_rows = params.max_rows
    partitions = max(params.least_partitions, -(-n_rows // params.rows_per_partition))
    # The learner asks for the rows of its input four times, and each time the
    # joins and the shuffle above would run again. A checkpoint keeps partitions
    # and order, which a written table would not.
    enable_checkpoints(train.sparkSession)
    laid_out = (
        labelled.repartition(partitions, key).sortWithinPartitions(key).checkpoint()
    )

    def fitted(num_trees: int, seed: int) -> RandomForestClassificationModel:
        return RandomForestClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            numTrees=num_trees,
            maxDepth=params.max_depth,
            maxBins=params.max_bins,
            seed=seed,
            maxMemoryInMB=params.memory_mb,
            cacheNodeIds=params.cache_node_ids,
        ).fit(laid_out)

    passes = min(params.num_trees, max(1, -(-n_rows * params.num_trees // MOST_BAGGED)))
    counts = [params.num_trees * (i + 1) // passes - params.num_trees * i // passes for i in range(passes)]
    if passes == 1:
        return fitted(params.num_trees, params.seed)
    # One at a time: a fitted part is saved before the next one.
    return trees.joined(train.sparkSession, (fitted(n, params.seed + i) for i, n in enumerate(counts)))


def is_large(model: RandomForestClassificationModel) -> bool:
    """Whether the forest is beyond what goes to a task at a time."""
    return model.totalNumNodes > MOST_NODES


def chosen_to_fit(key: Column, share: float, seed: int) -> Column:
    """Whether a row is among a share of all rows, by its key alone."""
    places = 1 << 30
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(places)) < F.lit(round(share * places))


def score_forest(
    df: DataFrame,
    model: RandomForestClassificationModel,
    signature: list[SignatureColumn],
    keep: list[str],
    whole_table: bool = False,
) -> DataFrame:
    """Score every row, by default without leaving the JVM.

    Adds ``prob`` (of class 1), ``classe_modelo`` (the model's own choice,
    class 0 at exactly one half) and ``classe_limiar`` (class 1 from one half).
    The forest goes to every task, so one beyond ``MOST_NODES`` raises.

    ``whole_table`` gives the same rows for a table of very many: they go
    through the trees in Arrow batches, at a fraction of the time for each row,
    but the model is read node by node first. A forest of any size will do: its
    trees go to the tasks in blocks of at most ``MOST_NODES``, or a single larger tree.
    """
    if not whole_table and is_large(model):
        raise ValueError(f"{model.totalNumNodes} nodes, more than {MOST_NODES}: score as a whole table")
    aligned = align(df.select("*", *_copies(keep)), signature, keep=_held(keep))
    if whole_table:
        scored = _answered(aligned, model, signature, _held(keep))
    else:
        scored = model.transform(_assemble(aligned, signature)).select(
            *[quoted(held) for held in _held(keep)],
            vector_to_array("probability")[1].alias("prob"),
            F.col("prediction").cast("int").alias("class"),
        )
    return scored.select(
        *[quoted(held).alias(c) for c, held in zip(keep, _held(keep))],
        "prob",
        F.col("class").alias("classe_modelo"),
        threshold_class(F.col("prob")).alias("classe_limiar"),
    )


def _answered(
    aligned: DataFrame, model: RandomForestClassificationModel, signature: list[SignatureColumn], held: list[str]
) -> DataFrame:
    """The held columns with ``prob`` and ``class``."""
    # By number, since columns of a batch are told apart by name.
    kept, names = [f"_k{i}" for i in range(len(held))], [f"_f{i}" for i in range(len(signature))]
    matrix = aligned.select(
        *[quoted(c).alias(k) for c, k in zip(held, kept)],
        *[quoted(s.name).cast("double").alias(f) for s, f in zip(signature, names)],
    )
    return trees.answer(matrix, model, names, MOST_NODES).toDF(*held, "prob", "class")


def _weight_of(label: Column, weights: list) -> Column:
    """The weight of each class, a literal per class."""
    by_class = F
    for row in weights:
        by_class = by_class.when(label == F.lit(row[0]), F.lit(row.weight))
    return by_class.otherwise(F.raise_error(F.lit("label without weight")).cast("double"))


def _assemble(df: DataFrame, signature: list[SignatureColumn]) -> DataFrame:
    """Put the signature columns into one vector; NULL becomes NaN, which a
    tree sends to the right."""
    renamed = df.select(
        *[quoted(c) for c in df.columns if c not in {s.name for s in signature}],
        *[quoted(s.name).alias(f"_f{i}") for i, s in enumerate(signature)],
    )
    names = [f"_f{i}" for i in range(len(signature))]
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(
        renamed
    )


def _held(keep: list[str]) -> list[str]:
    return [f"_keep_{c}" for c in keep]


def _copies(keep: list[str]):
    return [quoted(c).alias(held) for c, held in zip(keep, _held(keep))]
