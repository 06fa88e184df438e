"""Quality classifier: logistic regression on hashed word n-grams, by FTRL.

Features of a text are counts of hashed words and word pairs, of the shapes of
words (runs of lower, upper, digit and each symbol) and shape pairs, and of
words that repeat the one before. A count is divided by the square root of the
number of words. Weights come from follow-the-regularised-leader updates, one
document at a time in each shard of the training rows; shards are averaged.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.llm.common import hashed, ngrams, text_chunks, words_of


@dataclass(frozen=True)
class FtrlParams:
    """``max_rows`` bounds the labelled rows the model is fitted on (by hash of
    their id, about that many); ``shard_rows`` of them go to one task."""

    bits: int = 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    epochs: int = 3
    max_rows: int = 100_000
    shard_rows: int = 4_096


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[128:] = ord("a"), ord("a")
_SHAPE[65:91], _SHAPE[48:58] = ord("A"), ord("0")


def _shapes(data, starts, stops, offsets) -> np.ndarray:
    """Hash of each word's shape: character classes, runs taken once."""
    kinds = _SHAPE[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    keep = np.r_[True, kinds[1:] != kinds[:-1]] | first[:-1] if len(data) else first[:-1]
    place = np.r_[0, np.cumsum(keep)]
    return hashed(kinds[keep], place[starts], place[stops], place[offsets])[0]


def features_of(
    data: np.ndarray, offsets: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature index and row of every occurrence, and the words of each row."""
    words, rows, starts, stops = words_of(data, offsets, lower=False)
    count = np.bincount(rows, minlength=len(offsets) - 1)
    if not len(words):
        return np.empty(0, np.int64), rows, count
    shapes = _shapes(data, starts, stops, offsets)
    # Text between words has no part in a shape: a shape ends where its word does.
    pairs, pair_rows = ngrams(words, rows, 2, short=False)
    shape_pairs, _ = ngrams(shapes, rows, 2, short=False)
    repeat = np.r_[False, (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])]
    same = np.full(int(repeat.sum()), 1, np.uint64)
    parts = [words, pairs, shapes ^ np.uint64(0xA5A5), shape_pairs ^ np.uint64(0x5A5A), same]
    of = [rows, pair_rows, rows, pair_rows, rows[repeat]]
    index = (np.concatenate(parts) & np.uint64((1 << bits) - 2)).astype(np.int64) + 1
    # Index 0 is the constant.
    return index % (1 << bits), np.concatenate(of), count


def _train(params: FtrlParams) -> Callable[[pa.Table], pa.Table]:
    def train(group: pa.Table) -> pa.Table:
        group = group.sort_by("_order")
        size = 1 << params.bits
        z, n = np.zeros(size), np.zeros(size)
        documents = []
        for rows, data, offsets in text_chunks(iter(group.to_batches()), "_text"):
            index, of, count = features_of(data, offsets, params.bits)
            by = np.argsort(of, kind="stable")
            cut = np.searchsorted(of[by], np.arange(rows.num_rows + 1))
            marks = rows.column(rows.schema.get_field_index("_label")).to_numpy(zero_copy_only=False)
            for i in range(rows.num_rows):
                found, times = np.unique(index[by[cut[i] : cut[i + 1]]], return_counts=True)
                value = times / np.sqrt(max(1, count[i]))
                documents.append(
                    (np.r_[0, found].astype(np.int32), np.r_[1.0, value].astype(np.float32), marks[i])
                )
        for _ in range(params.epochs):
            for index, value, mark in documents:
                weight = weights(z[index], n[index], params)
                score = 1 / (1 + np.exp(-np.clip(weight @ value, -35, 35)))
                slope = (score - mark) * value
                after = n[index] + slope * slope
                z[index] += slope - (np.sqrt(after) - np.sqrt(n[index])) / params.alpha * weight
                n[index] = after
        final = weights(z, n, params)
        used = np.flatnonzero(final)
        return pa.table({"feature": pa.array(used, pa.int64()), "weight": final[used]})

    return train


def weights(z: np.ndarray, n: np.ndarray, params: FtrlParams) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - params.l1, 0)
    return -shrunk / ((params.beta + np.sqrt(n)) / params.alpha + params.l2)


def fit_quality(
    docs: DataFrame, marks: DataFrame, doc_id: str, text: str, params: FtrlParams = FtrlParams()
) -> np.ndarray:
    """The weight of each feature, from ``marks`` (doc_id, mark of 0 or 1).

    Marks are averaged per document; null ids and marks are ignored. Without
    any, all weights are zero and every score is one half.
    """
    marks = (
        marks.toDF("_id", "_label")
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .groupBy("_id")
        .agg((F.avg("_label") >= 0.5).cast("double").alias("_label"))
    )
    count = marks.count()
    hash_share = F.pmod(F.xxhash64("_id"), F.lit(1 << 30))
    marks = marks.where(hash_share < int((1 << 30) * min(1.0, params.max_rows / max(1, count))))
    shards = -(-min(count, params.max_rows) // params.shard_rows)
    # Two numbers for each of max_rows rows at most: a broadcast of known size.
    training = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(marks), "_id"
    )
    shard = F.pmod(F.xxhash64(F.lit("shard"), "_id"), F.lit(max(1, shards)))
    parts = (
        training.select(
            shard.alias("_shard"), F.xxhash64("_id", "_text").alias("_order"), "_text", "_label"
        )
        .groupBy("_shard")
        .applyInArrow(_train(params), "feature long, weight double")
        .groupBy("feature")
        .agg(F.sum("weight").alias("weight"))
    )
    found, total = parts.toArrow(), np.zeros(1 << params.bits)
    total[found["feature"].to_numpy()] = found["weight"].to_numpy()
    return total / max(1, shards)


def score_quality(
    docs: DataFrame, text: str, model: np.ndarray, keep: Sequence[str], name: str = "score"
) -> DataFrame:
    """The columns ``keep`` of every row and the score, between 0 and 1, of its
    text. An empty or null text has no features and gets the model's constant."""
    bits, kept = len(model).bit_length() - 1, list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*kept, F.col(text).alias("_text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "_text"):
            index, of, count = features_of(data, offsets, bits)
            sums = np.bincount(of, shared.value[index], minlength=rows.num_rows)
            sums = sums / np.sqrt(np.maximum(count, 1)) + shared.value[0]
            score = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(score)], [*kept, name]
            )

    schema = T.StructType([*docs.schema.fields[:-1], T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(scored, schema)
