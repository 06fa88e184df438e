"""What several operators share: reading, Arrow chunks, word hashes, components."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from crivo.sources.tables import scratch, staged

# Bytes of text that a task turns into hashes at a time: several arrays of
# eight bytes for each of them are alive meanwhile, and should fit a cache.
CHUNK_BYTES = 1 << 18
# The same where words alone are hashed and tasks share a cache: measured with six at
# a time, 39 CPU seconds a GB in chunks of 1 << 18 bytes, 27 in these.
WORD_BYTES = 1 << 16
# Edges that a task unites by itself, at a time.
EDGES_AT_ONCE = 1 << 17
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def multipliers(count: int) -> np.ndarray:
    """Odd factors, one for each position of an n-gram."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def text_chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with the bytes of their texts and the n+1 offsets; null is empty.

    A chunk ends before its texts pass ``limit`` bytes; one longer text is a
    chunk of its own.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).fill_null("")
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)
        offsets = offsets[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            part = offsets[start : end + 1]
            yield batch.slice(start, end - start), data[part[0] : part[-1]], part - part[0]
            start = end


def words_of(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (bytes outside 9-13 and 32): hash, row, start, end, in order."""
    if lower:
        data = _LOWER[data]
    inside = ~_SEPARATOR[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return *hashed(data, starts, stops, offsets), starts, stops


def hashed(
    data: np.ndarray, starts: np.ndarray, stops: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the byte ranges ``starts:stops``, which don't overlap."""
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sizes = stops - starts
    begin = np.cumsum(sizes) - sizes
    where = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    power = np.full(int(sizes.max()), _ODD)
    power[0] = 1
    power = np.cumprod(power)
    values = _BYTE[data[where + np.repeat(starts, sizes)]] * power[where]
    found = mix(np.add.reduceat(values, begin) + sizes.astype(np.uint64) * _ODD)
    return found, np.searchsorted(offsets, starts, "right") - 1


def ngrams(
    words: np.ndarray, rows: np.ndarray, n: int, short: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each n-gram. A row with fewer words than ``n`` has its
    whole sequence as one gram if ``short``, else none."""
    factors, total = multipliers(n + 1), len(words)
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = np.bincount(rows)
    left = np.cumsum(size)[rows] - np.arange(total)  # words from here to the row's end
    whole = left >= n
    if short:
        first = np.r_[True, rows[1:] != rows[:-1]]
        whole = whole | first
    grams = np.zeros(total, np.uint64)
    for i in range(n):
        inside = left > i
        at = np.flatnonzero(inside)
        grams[at] += words[at + i] * factors[i]
    grams += np.minimum(left, n).astype(np.uint64) * factors[n]
    return mix(grams[whole]), rows[whole]


def by_row(order: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """An order, resorted by row and otherwise left as it is."""
    numbers = rows[order]
    # Numbers of 16 bits are sorted by counting.
    if len(numbers) and numbers.max() < 1 << 16:
        numbers = numbers.astype(np.uint16)
    return order[np.argsort(numbers, kind="stable")]


def distinct_in_rows(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of each row once, sorted by row and value."""
    order = np.argsort(values)
    order = by_row(order, rows)
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its
    smallest node. Nulls link nothing.

    Each task unites the edges that it has, if nodes are whole numbers, which leaves
    a star for each of its components. Those of several tasks, and other edges, then
    alternate large stars (a node's larger neighbours go to its smallest) and small
    stars (its smaller neighbours and itself do) until the edges are stars. Minima
    combine before the shuffle, and the join that hands them out reads both sides
    from tables, so that adaptive execution can split the rows of a node with very
    many edges. Each round is written to the shared folder.
    """
    a, b = F.col(left), F.col(right)
    with scratch(edges.sparkSession):
        links = staged(
            edges.where(a != b)
            .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
            .distinct(),
            "links",
        )
        before = (links.count(), None)
        numbers = links.schema["high"].dataType == LongType()
        while before[0]:
            if numbers:
                # As many tasks as the edges need.
                tasks = 1 + before[0] // EDGES_AT_ONCE
                links = staged(links.coalesce(tasks).mapInArrow(_united, links.schema), "united")
                if tasks == 1:
                    break
            with scratch(edges.sparkSession):
                links = staged(_star_round(links), "links", result=True)
            after = _mark(links)
            if after == before:
                break
            before = after
        lows = links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
        stars = links.select(F.col("high").alias("node"), F.col("low").alias("component"))
        return staged(stars.unionByName(lows), "components", result=True)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges with the same components that lead to the smallest node of each, for
    a block of the rows at a time; all rows, if they are no more than a block."""
    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size > EDGES_AT_ONCE:
            held = [_stars(*map(np.concatenate, zip(*held)))]
            # What does not shrink goes out, so that no more than a block is held.
            if (size := len(held[0][0])) > EDGES_AT_ONCE // 2:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["high", "low"])
                held, size = [], 0
    if size:
        stars = _stars(*map(np.concatenate, zip(*held)))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, stars)), ["high", "low"])


def _stars(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node but the smallest of its component, and that one."""
    nodes, place = np.unique(np.r_[high, low], return_inverse=True)
    a, b = place[: len(high)], place[len(high) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def _star_round(links: DataFrame) -> DataFrame:
    """A large star and a small star."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("to"))
    least = staged(least.select("high", F.least("high", "to").alias("to")), "least")
    stars = (
        links.select(F.col("low").alias("near"), F.col("high").alias("far"))
        .join(least.withColumnRenamed("high", "near"), "near")
        .select(F.col("far").alias("high"), F.col("to").alias("low"))
        .distinct()
    )
    to = stars.groupBy("high").agg(F.min("low").alias("to"), F.count("low").alias("n"))
    several = to.where("n > 1").drop("n")
    moved = stars.join(several, "high").where("low != to")
    return (
        to.select("high", F.col("to").alias("low"))
        .unionByName(moved.select(F.col("low").alias("high"), F.col("to").alias("low")))
        .distinct()
    )


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()
    return row[0], row[1]
