"""Removal of long repeated byte strings by prefix-free parsing.

A rolling hash over a few bytes marks triggers, which lie at the same places of
equal strings, so texts fall into the same phrases wherever they repeat. Each
window of ``size`` bytes belongs to the first trigger in it, its anchor; windows of
a text with the same anchor are one phrase with what follows it: ``phrase`` bytes
before the anchor (a suffix of the phrase for each window), and the rest behind.
Where a text has no trigger for long, a denser set of triggers is taken, and at
last each window by itself, so every window has an anchor, which its bytes alone
decide.

All windows of an anchor share the first ``size - reach`` bytes behind it. Anchors
whose shared bytes stand nowhere else are done with. The others form the
dictionary: distinct phrases with their context. One that stands twice as a whole
is a repeat in all of its windows, which settles most of a repetitive corpus. Only
distinct ones that share those bytes and differ elsewhere, mostly at the ends of
repeats, are put into corpus order: what follows the anchors (the parse) is sorted
with the common prefixes of neighbours, the phrases (the dictionary) by their
suffixes with the common suffixes of neighbours. For a window with ``l`` bytes
before its anchor, the windows that start with the same bytes are those of the same
class of suffixes of length ``l`` within the same interval of prefixes of length
``size - l``: it is a repeat if there are two.

Contexts that share their bytes with very many others are not put into one task;
their windows are counted by hash over all tasks instead.
"""

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.operators.skew import salted_left_join
from crivo.session import fresh_path
from crivo.sources.tables import staged

_FACTOR = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)
_HOT_KEYS, _SALTS = 1000, 64


@dataclass(frozen=True)
class SuffixParams:
    """Strings of ``size`` bytes; triggers are hashes of ``window`` bytes, about one
    in ``triggers[0]`` places, or in the next number where none lies within
    ``reach`` bytes. ``reach + window`` is at most ``size``. Texts are parsed
    ``block`` bytes at a time; up to ``order_rows`` contexts that share bytes are
    sorted in one task."""

    size: int = 400
    window: int = 16
    reach: int = 256
    triggers: tuple[int, ...] = (128, 32, 8)
    block: int = 1 << 20
    order_rows: int = 4096


def rolling_hashes(data: np.ndarray, window: int) -> np.ndarray:
    """Polynomial hash of the ``window`` bytes (a power of two) from each place on."""
    hashes, width, factor = data.astype(np.uint32), 1, _FACTOR
    while width < window:
        hashes = hashes[:-width] * factor + hashes[width:]
        width, factor = width * 2, factor * factor
    return (hashes ^ (hashes >> np.uint32(15))) * _SPREAD


def anchors(data: np.ndarray, params: SuffixParams) -> np.ndarray:
    """The anchor of each window of ``size`` bytes."""
    n = len(data) - params.size + 1
    with np.errstate(over="ignore"):
        hashes = rolling_hashes(data, params.window)
    found, left = np.arange(n), np.arange(n)
    for rarity in params.triggers:
        triggers = np.flatnonzero(hashes < np.uint32((1 << 32) // rarity))
        if len(triggers):
            following = np.searchsorted(triggers, left)
            following = triggers[np.minimum(following, len(triggers) - 1)]
            near = (following >= left) & (following - left < params.reach)
            found[left[near]] = following[near]
            left = left[~near]
    return found


def phrases(data: bytes, params: SuffixParams) -> Iterator[tuple[np.ndarray, ...]]:
    """First and last window, anchor, hash of the shared bytes and both halves of
    the hash of the whole context, of each anchor; some bytes at a time."""
    for begin in range(0, len(data) - params.size + 1, params.block):
        part = data[begin : begin + params.block + params.size - 1]
        anchor = anchors(np.frombuffer(part, np.uint8), params)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:] - 1, len(anchor) - 1]
        anchor = anchor[first]
        view, shared = memoryview(part), params.size - params.reach
        inner = [xxhash.xxh3_64_intdigest(view[a : a + shared]) for a in anchor.tolist()]
        whole = b"".join(
            [xxhash.xxh3_128_digest(view[a : b + params.size]) for a, b in zip(first.tolist(), last.tolist())]
        )
        halves = np.frombuffer(whole, np.int64).reshape(-1, 2)
        yield first + begin, last + begin, anchor + begin, np.array(inner, np.uint64).view(np.int64), *halves.T


_PHRASE = "number long, first long, last long, anchor long, inner long, whole1 long, whole2 long"
_NAMES = ["number", "first", "last", "anchor", "inner", "whole1", "whole2"]


def _bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    column = batch.column(batch.schema.get_field_index(name))
    return (v.as_py() or b"" for v in column.cast(pa.large_binary()))


def _parsed(params: SuffixParams) -> Callable:
    def parse(batches):
        for batch in batches:
            waiting, rows = [], 0
            for number, data in zip(batch.column(0).to_pylist(), _bytes(batch, "text")):
                for found in phrases(data, params):
                    waiting.append((np.full(len(found[0]), number), *found))
                    rows += len(found[0])
                if rows > 50_000:
                    yield _merged(waiting)
                    waiting, rows = [], 0
            if waiting:
                yield _merged(waiting)

    return parse


def _merged(parts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], _NAMES)


def _contexts(params: SuffixParams) -> Callable:
    """The bytes before and behind the anchors wanted from each text."""

    def cut(batches):
        for batch in batches:
            columns = {c: [] for c in ("number", "anchor", "high", "low", "inner", "n", "left", "right")}
            size = 0
            for number, data, wanted in zip(
                batch.column(0).to_pylist(), _bytes(batch, "text"), batch.column(2).to_pylist()
            ):
                for w in wanted:
                    at = w["anchor"]
                    row = (number, at, at - w["first"], at - w["last"], w["inner"], w["n"])
                    texts = data[w["first"] : at], data[at : w["last"] + params.size]
                    for column, value in zip(columns.values(), row + texts):
                        column.append(value)
                    size += 1
                    if size == 20_000:
                        yield pa.RecordBatch.from_pydict(columns, _CONTEXT_ARROW)
                        columns, size = {c: [] for c in columns}, 0
            yield pa.RecordBatch.from_pydict(columns, _CONTEXT_ARROW)

    return cut


_CONTEXT = "number long, anchor long, high long, low long, inner long, n long, left binary, right binary"
_CONTEXT_ARROW = pa.schema(
    [(c, pa.binary() if kind == "binary" else pa.int64()) for c, kind in (x.split() for x in _CONTEXT.split(", "))]
)


def _matrix(texts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(-1, width)


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the one before; 0 first."""
    same = rows[1:] == rows[:-1]
    return np.r_[0, np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))]


def repeated_windows(inner, left: list[bytes], right: list[bytes], high, low, size: int) -> np.ndarray:
    """For contexts ordered by ``inner`` and ``right``: whether the window with
    ``l`` bytes before the anchor stands in another one, as columns ``l``."""
    n, width = len(left), -(-max(1, int(high.max())) // 8) * 8
    prefix = _common(_matrix(right, size))
    prefix[1:][inner[1:] != inner[:-1]] = 0
    backwards = _matrix([x[::-1] for x in left], width)
    words = backwards.reshape(n, width // 8, 8).view(">u8")[:, :, 0]
    order = np.lexsort(words.T[::-1])
    suffix = _common(backwards[order])
    found = np.zeros((n, int(high.max()) + 1), bool)
    kind = np.empty(n, np.int64)
    for length in range(int(low.min()), found.shape[1]):
        mine = np.flatnonzero((low <= length) & (length <= high))
        kind[order] = np.cumsum(suffix < length)
        key = np.cumsum(prefix < size - length) * (n + 1) + kind
        key = key[mine]
        by = np.argsort(key)
        key = key[by]
        same = key[1:] == key[:-1]
        found[mine[by], length] = np.r_[False, same] | np.r_[same, False]
    return found


def _ordered(params: SuffixParams) -> Callable:
    """Marks of repeats among sorted contexts; those that share bytes lie together."""

    def marks(table: pa.Table):
        number, anchor, high, low, inner, n = (table.column(i).to_numpy() for i in range(6))
        left, right = table.column(6).to_pylist(), table.column(7).to_pylist()
        found = repeated_windows(inner, left, right, high, low, params.size)
        found[n > 1] = False  # all of these are repeats anyway
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, least = np.nonzero(edge == 1)
        _, most = np.nonzero(edge == -1)
        columns = number[row], anchor[row] - most + 1, anchor[row] - least + params.size
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["number", "start", "stop"])

    def mark(batches):
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for start in range(0, batch.num_rows, params.order_rows):
                waiting.append(batch.slice(start, params.order_rows))
                rows += waiting[-1].num_rows
                if rows < 2 * params.order_rows:
                    continue
                table = pa.Table.from_batches(waiting)
                inner = table.column(4).to_numpy()
                # What shares bytes with the last row may go on in the next batch.
                end = int(np.flatnonzero(np.r_[True, inner[1:] != inner[:-1]])[-1])
                if end:
                    yield marks(table.slice(0, end))
                waiting = table.slice(end).to_batches()
                rows -= end
        if rows:
            yield marks(pa.Table.from_batches(waiting))

    return mark


def _windows(params: SuffixParams) -> Callable:
    """Each window of contexts with its hash."""

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                text = memoryview(row["left"] + row["right"])
                lengths = range(row["low"], row["high"] + 1)
                starts = [row["high"] - length for length in lengths]
                whole = b"".join(xxhash.xxh3_128_digest(text[s : s + params.size]) for s in starts)
                halves = np.frombuffer(whole, np.int64).reshape(-1, 2)
                at = row["anchor"] - np.array(lengths, np.int64)
                columns = np.full(len(at), row["number"]), at, np.full(len(at), row["n"]), halves[:, 0], halves[:, 1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["number", "start", "n", "h1", "h2"])

    return cut


def _cut(batches):
    for batch in batches:
        out = [], [], [], []
        for data, marks in zip(_bytes(batch, "text"), batch.column(2).to_pylist()):
            kept, at, removed, spans = sha256(), 0, 0, 0
            stop = -1
            for mark in sorted((m["start"], m["stop"]) for m in marks or ()):
                if mark[0] > stop:
                    spans += 1
                    kept.update(data[at : mark[0]])
                    at = stop = mark[0]
                if mark[1] > stop:
                    removed += mark[1] - stop
                    at = stop = mark[1]
            kept.update(data[at:])
            for column, value in zip(out, (len(data), removed, spans, kept.hexdigest())):
                column.append(value)
        columns = [pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(out[3], pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def _by_number(docs: DataFrame) -> DataFrame:
    """Numbered texts in buckets by number, written once: joins by number move
    no text after that."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"numbered_{uuid.uuid4().hex}"
    writer = docs.repartition(buckets, "number").write.format("parquet").option("compression", "zstd")
    writer.bucketBy(buckets, "number").option("path", fresh_path(spark, "numbered")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: its files lie in the shared folder
    return table


def remove_repeats(docs: DataFrame, id: str, text: str, params: SuffixParams = SuffixParams()) -> DataFrame:
    """Per row, its id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept_sha256`` of the bytes that are left.

    A byte goes if a string of ``size`` bytes over it also starts anywhere else in
    the table. Null texts are empty, and texts shorter than that lose nothing. Rows
    are kept apart by their place, so ids may be null or repeated; equal rows are
    copies of each other. Other columns of the table are not read.
    """
    chosen = docs.select(
        F.monotonically_increasing_id().alias("number"),
        F.col(id).alias("id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    texts = _by_number(chosen)
    long_enough = texts.where(F.octet_length("text") >= params.size).select("number", "text")
    parsed = long_enough.mapInArrow(_parsed(params), _PHRASE)
    several = staged(parsed.groupBy("inner").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "several")
    found = staged(_those_of(parsed, several, ["inner"]), "phrases")

    place = F.struct("number", "first", "last", "anchor")
    whole = ["inner", "whole1", "whole2"]
    kinds = staged(found.groupBy(*whole).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place")), "kinds")
    settled = _those_of(found, kinds.where("n > 1").select(*whole, "n"), whole)
    marks = settled.select("number", F.col("first").alias("start"), (F.col("last") + params.size).alias("stop"))

    shared = kinds.groupBy("inner").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = kinds.join(shared, "inner").select("place.*", "inner", "n", "kinds")
    many = F.col("kinds") > params.order_rows
    wanted = staged(wanted.withColumn("many", many).drop("kinds"), "wanted")
    sorted_ones = _cut_out(texts, wanted.where(~F.col("many")), params).repartition("inner")
    ordered = sorted_ones.sortWithinPartitions("inner", "right").mapInArrow(
        _ordered(params), "number long, start long, stop long"
    )
    counted = staged(_cut_out(texts, wanted.where("many"), params).mapInArrow(
        _windows(params), "number long, start long, n long, h1 long, h2 long"
    ), "windows")
    twice = counted.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    others = counted.where("n = 1").join(twice, ["h1", "h2"], "left_semi")
    marks = marks.unionByName(ordered).unionByName(
        others.select("number", "start", (F.col("start") + params.size).alias("stop"))
    )
    of_text = marks.groupBy("number").agg(F.collect_list(F.struct("start", "stop")).alias("marks"))
    kind = docs.schema[id].dataType.simpleString()
    return (
        texts.join(of_text, "number", "left")
        .select("id", "text", "marks")
        .mapInArrow(_cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        .withColumnRenamed("id", id)
    )


def _those_of(rows: DataFrame, counts: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is counted as ``n`` of them. Keys with at least one in
    ``_HOT_KEYS`` of these rows, of which there cannot be more than that, are
    spread over tasks."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * _HOT_KEYS >= total).select(on[-1]).distinct()
    spread = F.struct("number", "first")
    known = counts.select(*on, F.lit(True).alias("_known"))
    return salted_left_join(rows, known, on, on[-1], spread, hot, _SALTS).where("_known").drop("_known")


def _cut_out(texts: DataFrame, wanted: DataFrame, params: SuffixParams) -> DataFrame:
    place = F.struct("first", "last", "anchor", "inner", "n")
    of_text = wanted.groupBy("number").agg(F.collect_list(place).alias("wanted"))
    return texts.join(of_text, "number").select("number", "text", "wanted").mapInArrow(_contexts(params), _CONTEXT)
