"""Resampling towards a target distribution by hashed n-gram importance weights.

A 256-byte table lower-cases A-Z and blanks all ASCII that is no letter or digit
within the UTF-8 bytes of a text, so that ``bytes.split`` yields its words. The
crc32 of a word run is that of the run without its last word, carried on over a
blank and that word: a seed for each longer n-gram. Each task counts buckets of
features in a Counter, a million features at a time, and the Counters are reduced
by bucket; what the driver holds is one number for each bucket, whatever the size
of the corpus.

A text is split block by block, so the words of a very long one are never in
memory together. Ranks come from a sort by ranges: a document's rank is its place
in its range behind the sizes of the ranges before, so no task sees all of them.
"""

import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.sources.tables import staged

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
_KEPT = bytes(range(ord("0"), ord("9") + 1)) + _LETTERS + bytes(range(128, 256))
_TABLE = bytes(b if b in _KEPT else 32 for b in bytes(range(256)).lower())
# Bytes of a text that are split at a time, and hashes that are counted at a time.
BLOCK = 1 << 20
COUNTED = 1 << 20


@dataclass(frozen=True)
class ResampleParams:
    """Runs of 1 to ``order`` words in ``buckets`` buckets. Of the documents with at
    least ``least_words`` words, ``percent`` in a hundred are drawn without
    replacement, by Gumbel noise from the ``seed`` and the id."""

    order: int = 3
    buckets: int = 10_000
    seed: int = 42
    least_words: int = 20
    percent: int = 5


def _blocks(data: bytes, size: int) -> Iterator[list[bytes]]:
    """Words of a translated text, some bytes at a time, never within a word."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size) if start + size < len(data) else -1
        end = len(data) if end < 0 else end
        if words := data[start:end].split():
            yield words
        start = end


def feature_hashes(data: bytes, order: int, block: int = BLOCK) -> Iterator[list[list[int]]]:
    """crc32 of the word runs of a text: for each block, those of one word, of two
    and so on that end in it."""
    ends: list[list[int]] = [[] for _ in range(order)]
    for words in _blocks(data.translate(_TABLE), block):
        longer = [b" " + w for w in words]
        grams = [list(map(crc32, words))]
        for before in ends[:-1]:
            seeds = before + grams[-1]
            grams.append(list(map(crc32, longer[len(words) + 1 - len(seeds) :], seeds)))
        ends = [g[-1:] for g in grams]
        yield grams


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column(batch.schema.get_field_index("_text")).cast(pa.large_binary()):
        yield value.as_py() or b""


def _buckets(hashes: array, params: ResampleParams) -> np.ndarray:
    return np.frombuffer(hashes, np.uint32) % np.uint32(params.buckets)


def _counted(params: ResampleParams) -> Callable:
    def count(batches):
        counts: Counter[int] = Counter()
        waiting = array("I")

        def add():
            times = np.bincount(_buckets(waiting, params), minlength=params.buckets)
            counts.update(dict(enumerate(times.tolist())))

        for batch in batches:
            for data in _texts(batch):
                for grams in feature_hashes(data, params.order):
                    for hashes in grams:
                        waiting.extend(hashes)
                    if len(waiting) >= COUNTED:
                        add()
                        waiting = array("I")
        add()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["bucket", "n"]
        )

    return count


def _bucket_counts(texts: DataFrame, params: ResampleParams) -> list[int]:
    """Features in each bucket, as many numbers as there are buckets."""
    counts = texts.mapInArrow(_counted(params), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = [0] * params.buckets
    for row in counts.collect():
        found[row.bucket] = row.n
    return found


def bucket_gains(raw: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of smoothed bucket shares, target to raw."""
    n, all_raw, all_target = len(raw), float(sum(raw)), float(sum(target))
    return [
        math.floor(1000.0 * math.log((t + 1.0) * (all_raw + n) / ((s + 1.0) * (all_target + n))))
        for s, t in zip(raw, target)
    ]


def _weighed(gains: list[int], params: ResampleParams) -> Callable:
    def weigh(batches):
        gain_of = np.array(gains, np.int64)
        for batch in batches:
            words, features, weights = [], [], []
            for data in _texts(batch):
                n_words = n = weight = 0
                for grams in feature_hashes(data, params.order):
                    n_words += len(grams[0])
                    found = array("I")
                    for hashes in grams:
                        found.extend(hashes)
                    n += len(found)
                    weight += int(gain_of[_buckets(found, params)].sum())
                words.append(n_words)
                features.append(n)
                weights.append(weight)
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weights))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    return weigh


def importance_resample(
    docs: DataFrame, target: DataFrame, id: str, text: str, target_text: str, params: ResampleParams = ResampleParams()
) -> DataFrame:
    """Weight, score and rank of every document: columns ``id``, ``n_words``,
    ``n_features``, ``weight``, ``score``, ``rank``; the rank is null if not drawn.

    Null and empty texts hold no features and weigh 0. A null id draws the noise
    of an empty one. Rows with equal score and id are ranked in any order, which
    cannot be told apart unless their other columns differ; null ids come last
    among equal scores. An empty target or corpus counts as all zeros. Other
    columns of the tables, whatever their names, are not read.
    """
    chosen = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    raw = _bucket_counts(chosen.select("_text"), params)
    aim = _bucket_counts(target.select(F.col(target_text).alias("_text")), params)
    kind = chosen.schema["_id"].dataType.simpleString()
    weighed = chosen.mapInArrow(
        _weighed(bucket_gains(raw, aim), params), f"id {kind}, n_words long, n_features long, weight long"
    )
    name = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = staged(weighed.withColumn("score", F.col("weight") + noise), "scored")
    return _ranked(scored, params)


def _ranked(scored: DataFrame, params: ResampleParams) -> DataFrame:
    long_enough = F.col("n_words") >= params.least_words
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # Partition in the upper bits, place within it in the lower 33.
    place = F.monotonically_increasing_id()
    ranges = staged(
        scored.where(long_enough).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", place),
        "ranges",
    )
    part = F.shiftright("_at", 33)
    sizes = sorted((r.part, r.n) for r in ranges.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    drawn = sum(n for _, n in sizes) * params.percent // 100
    before, rows = 0, []
    for number, n in sizes:
        rows.append((number, before))
        before += n
    # As many rows as the sort has partitions.
    starts = scored.sparkSession.createDataFrame(rows, "_part long, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = (
        ranges.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*scored.columns, F.when(rank <= drawn, rank).alias("rank"))
    )
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
