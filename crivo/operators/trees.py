"""A fitted forest as arrays, and its answers for batches of rows.

The library walks a tree of objects for each row and tree. Here rows of a block
go down a tree together, a level at a time. A level asks for array elements that
lie close to each other, so a row takes a fraction of the time. Thresholds and
votes are the model's doubles, and votes are summed in tree order, so answers are
the model's own to the last bit.
"""

import contextlib
import json
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.session import fresh_path
from crivo.sources.tables import remove

# Tasks get this module's code with their work: scoring asks for no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that go down together, and how many answers to single splits they may have.
BLOCK_ROWS, BLOCK_ANSWERS = 2048, 1 << 21
# Nodes that go to every task at a time, some 100 bytes each.
MOST_NODES = 5_000_000


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees, end to end. ``left`` and ``right`` are positions, a
    leaf's its own; ``split`` is the number of a node's split, a leaf's is one
    behind the last. ``votes``: what a leaf adds to each class."""

    splits: list[tuple[int, int, tuple[float, ...]]]
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    votes: np.ndarray
    roots: list[int]
    depths: list[int]

    def goes_right(self, number: int, values: np.ndarray) -> np.ndarray:
        feature, categories, left = self.splits[number]
        value = values[feature]
        if categories < 0:
            return ~(value <= left[0])
        # The library keeps the smaller side, and sends unknown values to the other.
        if len(left) <= categories // 2:
            return ~np.isin(value, left)
        return np.isin(value, np.setdiff1d(np.arange(categories), left))


def trees_of(model: RandomForestClassificationModel, spark) -> Trees:
    """The model's nodes, read from its saved form."""
    with _nodes(model, spark) as nodes:
        return _trees(nodes)


@contextlib.contextmanager
def _nodes(model: RandomForestClassificationModel, spark: SparkSession) -> Iterator[DataFrame]:
    """The model's nodes as rows, while the block lasts."""
    path = fresh_path(spark, "forest")
    try:
        model.write().save(path)
        node = F.col("nodeData")
        yield spark.read.parquet(f"{path}/data").select(
            "treeID",
            node["id"].alias("id"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"),
            node["split"]["numCategories"].alias("categories"),
            node["split"]["leftCategoriesOrThreshold"].alias("cut"),
            node["impurityStats"].alias("stats"),
        )
    finally:
        remove(spark, path)


def _blocks(nodes: DataFrame, most_nodes: int) -> list[tuple[int, int]]:
    """First and last tree of blocks that stay within the nodes, if a tree does."""
    blocks, held = [], 0
    for tree, n in sorted(nodes.groupBy("treeID").count().collect()):
        if not blocks or held + n > most_nodes:
            blocks.append((tree, tree))
            held = 0
        blocks[-1], held = (blocks[-1][0], tree), held + n
    return blocks


def joined(spark: SparkSession, parts: Iterable[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of the trees of several, in their order. Of the parts one at a time
    is held."""
    paths, whole = [], fresh_path(spark, "forest")
    try:
        trees, found = 0, {"data": [], "treesMetadata": []}
        for part in parts:
            paths.append(fresh_path(spark, "forest"))
            part.write().save(paths[-1])
            for folder, tree in (("data", "treeID"), ("treesMetadata", "_1")):
                rows = spark.read.parquet(f"{paths[-1]}/{folder}")
                found[folder].append(rows.withColumn(tree, F.col(tree) + F.lit(trees)))
            trees += part.getNumTrees
        about = json.loads(spark.read.text(f"{paths[0]}/metadata").first().value)
        about["numTrees"] = about["paramMap"]["numTrees"] = trees
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{whole}/metadata")
        for folder, rows in found.items():
            reduce(DataFrame.union, rows).write.parquet(f"{whole}/{folder}")
        return RandomForestClassificationModel.load(whole)
    finally:
        for path in (*paths, whole):
            remove(spark, path)


def _trees(nodes: DataFrame) -> Trees:
    found = nodes.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    tree, left, right, feature, categories = (
        found[c].to_numpy() for c in ("treeID", "left", "right", "feature", "categories")
    )
    n, at = len(tree), np.arange(len(tree))
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    # Ids of a tree are positions in it.
    base = np.repeat(first, np.diff(np.r_[first, n]))
    leaf = left < 0
    left, right = np.where(leaf, at, left + base), np.where(leaf, at, right + base)

    numbers, split = {}, np.empty(n, np.int32)
    inner = np.flatnonzero(~leaf)
    cuts = found["cut"].combine_chunks().take(pa.array(inner)).to_pylist()
    for i, f, k, cut in zip(inner.tolist(), feature[inner].tolist(), categories[inner].tolist(), cuts):
        split[i] = numbers.setdefault((f, k, tuple(cut)), len(numbers))
    split[leaf] = len(numbers)

    stats = found["stats"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    total = np.zeros(n)
    for count in stats.T:
        total = total + count
    votes = np.divide(stats, total[:, None], out=np.zeros_like(stats), where=total[:, None] != 0)

    depth = np.zeros(n, np.int32)
    level, steps = first, 0
    while len(level := level[~leaf[level]]):
        level, steps = np.r_[left[level], right[level]], steps + 1
        depth[base[level]] = steps
    return Trees(
        list(numbers),
        split,
        left.astype(np.int32),
        right.astype(np.int32),
        np.ascontiguousarray(votes.T),
        first.tolist(),
        depth[first].tolist(),
    )


class Walker:
    """Answers of ``trees``, for a block of rows at a time."""

    def __init__(self, trees: Trees):
        self.trees = trees
        self.rows = max(16, min(BLOCK_ROWS, BLOCK_ANSWERS // (len(trees.splits) + 1)))
        # Nodes are known by twice their position, and a step is one look-up.
        self.children = 2 * np.stack([trees.left, trees.right], 1).astype(np.int64).ravel()
        self.answers = np.repeat(trees.split.astype(np.int64) * self.rows, 2)

    def votes(self, values: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Votes (class, row) for values (feature, row), summed to those of earlier trees."""
        out = np.empty(before.shape)
        for start in range(0, values.shape[1], self.rows):
            some = values[:, start : start + self.rows]
            width = some.shape[1]
            votes = np.zeros((len(before), self.rows))
            votes[:, :width] = before[:, start : start + width]
            out[:, start : start + width] = self._block(some, votes)[:, :width]
        return out

    def _block(self, values: np.ndarray, votes: np.ndarray) -> np.ndarray:
        trees, width = self.trees, values.shape[1]
        right = np.zeros((len(trees.splits) + 1, self.rows), np.uint8)
        for i in range(len(trees.splits)):
            right[i, :width] = trees.goes_right(i, values)
        right, rows = right.ravel(), np.arange(self.rows)
        for root, depth in zip(trees.roots, trees.depths):
            node = np.full(self.rows, 2 * root)
            for _ in range(depth):
                answer = self.answers.take(node)
                answer += rows
                node += right.take(answer)
                node = self.children.take(node)
            node >>= 1
            for total, own in zip(votes, trees.votes):
                total += own.take(node)
        return votes


def _columns(columns: list) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False) for c in columns]).astype(float, copy=False)


def _summed(trees, kept: int, features: int, names: list[str]) -> Callable:
    """Batches with the votes of these trees, on top of those that the batches have."""

    def summed(batches):
        walker = Walker(Trees(**trees.value))
        for batch in batches:
            values, earlier = batch.columns[kept : kept + features], batch.columns[kept + features :]
            before = _columns(earlier) if earlier else np.zeros((len(names), batch.num_rows))
            votes = walker.votes(_columns(values), before)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: kept + features], *map(pa.array, votes)],
                [*batch.schema.names[: kept + features], *names],
            )

    return summed


def _answered(trees, kept: int, features: int, names: list[str]) -> Callable:
    def answered(batches):
        for batch in _summed(trees, kept, features, names)(batches):
            votes = _columns(batch.columns[kept + features :])
            total = np.zeros(batch.num_rows)
            for own in votes:
                total = total + own
            prob = np.divide(votes[1], total, out=votes[1].copy(), where=total != 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(prob), pa.array(votes.argmax(0).astype(np.int32))],
                [*batch.schema.names[:kept], "_prob", "_class"],
            )

    return answered


def answer(
    matrix: DataFrame, model: RandomForestClassificationModel, features: list[str], most_nodes: int = MOST_NODES
) -> DataFrame:
    """``matrix`` without its feature columns, which are doubles, and with
    ``_prob`` (of class 1) and ``_class``, as the model gives them.

    A forest of more than ``most_nodes`` goes to the tasks in blocks of trees. Rows are
    then written with the votes so far, and read again for the next block."""
    spark = matrix.sparkSession
    kept = [c for c in matrix.columns if c not in features]
    matrix = matrix.select(*kept, *features)
    names, written = [f"_votes_{i}" for i in range(model.numClasses)], None
    with _nodes(model, spark) as nodes:
        blocks = _blocks(nodes, most_nodes)
        for first, last in blocks:
            some = _trees(nodes.where(F.col("treeID").between(first, last)))
            trees = spark.sparkContext.broadcast(vars(some))
            if last == blocks[-1][1]:
                break
            schema = T.StructType([matrix.schema[c] for c in (*kept, *features)])
            for name in names:
                schema = schema.add(name, T.DoubleType())
            path = fresh_path(spark, "votes")
            matrix.mapInArrow(_summed(trees, len(kept), len(features), names), schema).write.parquet(path)
            trees.destroy()
            if written is not None:
                remove(spark, written)
            matrix, written = spark.read.schema(schema).parquet(path), path
    schema = T.StructType([matrix.schema[c] for c in kept]).add("_prob", T.DoubleType()).add("_class", T.IntegerType())
    return matrix.mapInArrow(_answered(trees, len(kept), len(features), names), schema)
