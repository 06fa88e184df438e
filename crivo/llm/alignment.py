"""Alignment of two tokenizers over a corpus: which tokens of one end where tokens
of the other do, how often, and which partner is a token's most frequent one.

The texts are encoded by both tokenizers chunk by chunk. A chunk begins with white
space, which no token of either reaches across from a character before it, so its
ids don't depend on what stands around it; a chunk that a task has met is looked up.
Ends that both tokenizers share cut a text into groups.

Most groups are one token against one of the same bytes. For these an array from
the ids of the first tokenizer to those of the second, made beforehand from the
bytes of both vocabularies, says the partner, and they are counted in one vector as
long as the vocabulary. Only the links of all other groups are counted as pairs. Of
those, pairs that make up at least ``1 / hot_pairs`` of all links, of which there
cannot be more than ``hot_pairs``, are looked up in a table sent to every task; the
rest, none of which is frequent, meets its counts by a join on the pair.
"""

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.llm.packing import byte_bpe_encoder
from crivo.llm.units import gather
from crivo.sources.tables import staged

BLANK = "▁"
# A run of white space and what follows, up to white space that begins a chunk.
# Other white space than blanks, line feeds and tabs never begins one by itself.
_CHUNK = re.compile(rf"[\s{BLANK}]*[^\s{BLANK}]+(?:(?![ \n\t])[\s{BLANK}]+[^\s{BLANK}]*)*|[\s{BLANK}]+")
_CROSSES = re.compile(rf"[^\s{BLANK}][ \n\t{BLANK}]")


@dataclass(frozen=True)
class AlignParams:
    """``block`` chunks are aligned at a time, and about ``remembered`` characters
    of chunks looked up. At most ``hot_pairs`` pairs are sent to every task."""

    block: int = 1 << 17
    remembered: int = 4_000_000
    hot_pairs: int = 1 << 18


def byte_level_tokens(data: bytes) -> list[bytes]:
    """Bytes of each id of a byte-level BPE file, which writes bytes that are no
    printable characters as those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    written = {chr(b): b for b in plain}
    written |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    vocabulary = json.loads(data)["model"]["vocab"]
    found = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in written for c in token):
            found[i] = bytes(written[c] for c in token)
    return found


def piece_tokens(pieces) -> list[bytes]:
    """Bytes of each id of a SentencePiece processor."""
    return [
        bytes([int(p[1:-1], 16)]) if pieces.is_byte(i) else p.replace(BLANK, " ").encode()
        for i, p in ((i, pieces.id_to_piece(i)) for i in range(pieces.get_piece_size()))
    ]


class Tokenizers:
    """Both vocabularies; ``encode`` gives the ids of chunks by both."""

    def __init__(self, byte_bpe: bytes, piece_model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_proto=piece_model)
        self.bytes_a = byte_level_tokens(byte_bpe)
        self.bytes_b = piece_tokens(self.pieces)
        self._encode_a = byte_bpe_encoder(byte_bpe)
        self._lead = len(self.pieces.encode("a"))
        # Ids of a chunk alone are those of the chunk in its text only if no
        # piece holds what parts chunks.
        self.parted = not any(
            _CROSSES.search(self.pieces.id_to_piece(i)) for i in range(len(self.bytes_b))
        )

    @cached_property
    def same(self) -> np.ndarray:
        """The id of the second tokenizer with the bytes of each id of the first,
        or -1. A piece goes before the byte that it falls back to."""
        of = {}
        for i in sorted(range(len(self.bytes_b)), key=self.pieces.is_byte):
            if not (self.pieces.is_control(i) or self.pieces.is_unknown(i)):
                of.setdefault(self.bytes_b[i], i)
        return np.array([of.get(b, -1) if b else -1 for b in self.bytes_a], np.int64)

    def chunks(self, text: str) -> Iterator[str]:
        """Chunks of a blank and the text."""
        if not self.parted:
            return iter([" " + text])
        return (m.group() for m in _CHUNK.finditer(" " + text))

    def encode(self, chunks: list[str]) -> tuple[list, list]:
        first = [np.asarray(self._encode_a(c)) for c in chunks]
        # The library puts a blank before a text, if there is any. Other chunks go
        # behind a letter, the ids of which are dropped.
        blank = [len(c) > 1 and c[0] == " " for c in chunks]
        second = self.pieces.encode([c[1:] if b else "a" + c for c, b in zip(chunks, blank)], num_threads=1)
        return first, [i if b else i[self._lead :] for i, b in zip(second, blank)]


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.concatenate([np.asarray(x, np.int64) for x in lists]), sizes


class Chunks:
    """Aligned chunks that a task has met, by number."""

    def __init__(self, tokenizers: Tokenizers):
        self.of = tokenizers
        self.width = len(tokenizers.bytes_b)
        self.size_a = np.fromiter(map(len, tokenizers.bytes_a), np.int64)
        self.size_b = np.fromiter(map(len, tokenizers.bytes_b), np.int64)
        # Ids as text, with what stands behind them within and at the end of
        # their side of a group.
        self.text_a, self.text_b = (
            [[b"%d%s" % (i, mark) for i in range(n)] for mark in (b",", end)]
            for n, end in ((len(tokenizers.bytes_a), b"|"), (self.width, b";"))
        )
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.characters = 0
        self.written: list[bytes] = []
        self.counts = np.empty((0, 4), np.int64)  # tokens by both, groups, whether bytes are kept
        none = np.empty(0, np.int64)
        self.same, self.pairs = (none, none, none), (none, none, none)  # values, starts, sizes

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that are not known yet, all at once."""
        if not chunks:
            return
        first, second = self.of.encode(chunks)
        a, n_a = _flat(first)
        b, n_b = _flat(second)
        raw = [c.encode() for c in chunks]
        bytes_a, bytes_b = self.of.bytes_a, self.of.bytes_b
        kept = np.fromiter(
            (
                r == b"".join(map(bytes_a.__getitem__, x)) == b"".join(map(bytes_b.__getitem__, y))
                for r, x, y in zip(raw, first, second)
            ),
            bool,
            len(raw),
        )
        # Chunks whose bytes differ make their texts have no tokens.
        chunk_a, chunk_b = (np.repeat(np.arange(len(raw)), n) for n in (n_a, n_b))
        a, chunk_a, b, chunk_b = a[kept[chunk_a]], chunk_a[kept[chunk_a]], b[kept[chunk_b]], chunk_b[kept[chunk_b]]
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        of = chunk_a[last_a]  # the chunk of each group
        alone = (np.bincount(group_a, minlength=len(ends)) == 1) & (np.bincount(group_b, minlength=len(ends)) == 1)
        regular = alone & (self.of.same[a[last_a]] == b[last_b])
        n = len(raw)
        self.counts = np.concatenate(
            [
                self.counts,
                np.stack(
                    [np.bincount(x, minlength=n) for x in (chunk_a, chunk_b, of)] + [kept.astype(np.int64)], axis=1
                ),
            ]
        )
        self.same = self._more(self.same, a[last_a][regular], of[regular], n)
        links = a[last_a] * self.width + b[last_b]
        self.pairs = self._more(self.pairs, links[~regular], of[~regular], n)
        # Sides of groups in the order in which they are written.
        place = np.r_[group_a * 2, group_b * 2 + 1]
        order = np.argsort(place, kind="stable")
        text = [self.text_a[end][i] for i, end in zip(a.tolist(), np.isin(ends_a, ends).tolist())]
        text += [self.text_b[end][i] for i, end in zip(b.tolist(), np.isin(ends_b, ends).tolist())]
        bounds = np.r_[0, np.cumsum(np.bincount(np.r_[chunk_a, chunk_b], minlength=n))].tolist()
        text = [text[i] for i in order.tolist()]
        self.written += [b"".join(text[i:j]) for i, j in zip(bounds, bounds[1:])]
        self.characters += sum(map(len, chunks))

    @staticmethod
    def _more(known, values, of, n):
        old, starts, sizes = known
        more = np.bincount(of, minlength=n)
        return (
            np.r_[old, values],
            np.r_[starts, len(old) + np.cumsum(more) - more],
            np.r_[sizes, more],
        )

    def numbered(self, chunks: list[str], remembered: int) -> np.ndarray:
        if self.characters > remembered:
            self.forget()
        numbers = self.numbers
        new = [c for c in dict.fromkeys(chunks) if c not in numbers]
        for c in new:
            numbers[c] = len(numbers)
        self.learn(new)
        return np.fromiter(map(numbers.__getitem__, chunks), np.int64, len(chunks))


_loaded: dict[int, Chunks] = {}


def _chunks(byte_bpe: bytes, piece_model: bytes) -> Chunks:
    """What the worker has met in earlier tasks, too."""
    key = hash((byte_bpe, piece_model))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Chunks(Tokenizers(byte_bpe, piece_model))
    return _loaded[key]


def _counted(values: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each stands there."""
    if times is None:
        return np.unique(values, return_counts=True)
    if not len(values):
        return values, times
    order = np.argsort(values, kind="stable")
    values, times = values[order], times[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[first], np.add.reduceat(times, first)


def _blocks(texts, tokenizers: Tokenizers, block: int) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Rows, how many chunks follow of each, and these; a long text goes on in the
    next block."""
    rows, sizes, chunks = [], [], []
    for row, text in enumerate(texts):
        if not text:
            continue
        rows.append(row)
        begin = len(chunks)
        for chunk in tokenizers.chunks(text):
            chunks.append(chunk)
            if len(chunks) == block:
                sizes.append(len(chunks) - begin)
                yield rows, sizes, chunks
                rows, sizes, chunks, begin = [row], [], [], 0
        sizes.append(len(chunks) - begin)
    if chunks:
        yield rows, sizes, chunks


def _lists(keys: np.ndarray, times: np.ndarray, base: int, n: int) -> tuple[pa.Array, pa.Array]:
    """Per row, the values in ``row * base + value`` and their times."""
    rows = keys // base
    offsets = pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(keys - rows * base)), pa.ListArray.from_arrays(
        offsets, pa.array(times)
    )


_ALIGNED = (
    "n_a long, n_b long, n_groups long, groups_sha256 string, "
    "same array<long>, same_n array<long>, pairs array<long>, pairs_n array<long>"
)


def _aligned(byte_bpe: bytes, piece_model: bytes, params: AlignParams) -> Callable:
    def align(batches):
        known = _chunks(byte_bpe, piece_model)
        base = len(known.of.bytes_a), len(known.of.bytes_a) * known.width
        for batch in batches:
            texts = (t.as_py() for t in batch.column(batch.schema.get_field_index("_text")))
            n = batch.num_rows
            counts = np.zeros((n, 3), np.int64)
            kept = np.ones(n, bool)
            hashes, behind = {}, {}
            found = ([], []), ([], [])  # keys and times of identical tokens, and of pairs
            for rows, sizes, chunks in _blocks(texts, known.of, params.block):
                numbers = known.numbered(chunks, params.remembered)
                row_of = np.repeat(np.array(rows), sizes)
                for i in range(3):
                    counts[:, i] += np.bincount(row_of, known.counts[numbers, i], n).astype(np.int64)
                kept[row_of[known.counts[numbers, 3] == 0]] = False
                end = 0
                for row, size in zip(rows, sizes):
                    part = b"".join(map(known.written.__getitem__, numbers[end : end + size].tolist()))
                    end += size
                    if not part:
                        continue
                    # The last mark of a text is not written.
                    hashes.setdefault(row, sha256()).update(behind.get(row, b"") + part[:-1])
                    behind[row] = part[-1:]
                for (keys, times), (values, starts, widths), b in zip(found, (known.same, known.pairs), base):
                    mine = np.repeat(row_of, widths[numbers]) * b + gather(values, starts, widths, numbers)
                    for out, x in zip((keys, times), _counted(mine)):
                        out.append(x)
            counts[~kept] = 0
            columns = [pa.array(counts[:, i]) for i in range(3)]
            valid = kept & (counts[:, 0] > 0)
            columns.append(pa.array([hashes[i].hexdigest() if valid[i] else "" for i in range(n)], pa.string()))
            for (keys, times), b in zip(found, base):
                keys, times = (np.concatenate([np.empty(0, np.int64), *x]) for x in (keys, times))
                mine = valid[keys // b]
                columns += _lists(*_counted(keys[mine], times[mine]), b, n)
            names = ["n_a", "n_b", "n_groups", "groups_sha256", "same", "same_n", "pairs", "pairs_n"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["_row", "_id", *names])

    return align


def _values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The row of each value of a list column."""
    sizes = batch.column(batch.schema.get_field_index(name)).value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(batch.num_rows), sizes)


def _link_counts(length: int, most: int = 1 << 20) -> Callable:
    """Partial counts of a task: identical tokens in one vector as long as the
    vocabulary, the links of other groups by pair."""

    def rows(same, keys, times):
        flag = pa.array(np.full(len(keys), same))
        return pa.RecordBatch.from_arrays([flag, pa.array(keys), pa.array(times)], ["same", "key", "n"])

    def count(batches):
        vector = np.zeros(length, np.int64)
        keys, times = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            np.add.at(vector, _values(batch, "same"), _values(batch, "same_n"))
            keys, times = _counted(
                np.r_[keys, _values(batch, "pairs")], np.r_[times, _values(batch, "pairs_n")]
            )
            if len(keys) > most:
                yield rows(False, keys, times)
                keys, times = np.empty(0, np.int64), np.empty(0, np.int64)
        yield rows(False, keys, times)
        used = np.flatnonzero(vector)
        yield rows(True, used, vector[used])

    return count


def _summed(vector, best, same, hot_keys, hot_n, width) -> Callable:
    """Sums over the links whose counts are at hand, and the pairs left over."""

    def add(batches):
        best_a = (vector > 0) & (vector == best[np.maximum(same.value, 0)])
        for batch in batches:
            n = batch.num_rows
            n_best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)

            def put(rows, times, counts, is_best):
                np.add.at(total, rows, times * counts)
                np.add.at(n_best, rows[is_best], times[is_best])

            ids = _values(batch, "same")
            put(_rows(batch, "same"), _values(batch, "same_n"), vector[ids], best_a[ids])
            pairs, times, rows = _values(batch, "pairs"), _values(batch, "pairs_n"), _rows(batch, "pairs")
            at = np.minimum(np.searchsorted(hot_keys.value, pairs), max(len(hot_keys.value) - 1, 0))
            hot = hot_keys.value[at] == pairs if len(hot_keys.value) else np.zeros(len(pairs), bool)
            counts = hot_n.value[at[hot]]
            put(rows[hot], times[hot], counts, counts == best[pairs[hot] % width])
            offsets = pa.array(np.searchsorted(rows[~hot], np.arange(n + 1)).astype(np.int32))
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~hot])) for x in (pairs, times)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in _KEPT]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_best), pa.array(total), *rest], [*_KEPT, "n_best", "count_sum", "rare", "rare_n"]
            )

    return add


_KEPT = ["_row", "_id", "n_a", "n_b", "n_groups", "groups_sha256"]


def aligned_tokens(
    docs: DataFrame, id: str, text: str, byte_bpe: bytes, piece_model: bytes, params: AlignParams = AlignParams()
) -> DataFrame:
    """Per row, its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``.

    Null and empty texts, and those that a tokenizer does not give back byte by
    byte, have no tokens: zeros, and an empty hash. Rows are kept apart by their
    place, so ids may be null or repeated; equal texts have equal results. An id
    pair's count is over all rows. Other columns of the table are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    chosen = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id).alias("_id"), F.col(text).alias("_text")
    )
    # Encoded once; the rows are numbered in the same job, so the numbers stay.
    aligned = staged(
        chosen.mapInArrow(_aligned(byte_bpe, piece_model, params), f"_row long, _id {kind}, {_ALIGNED}"), "aligned"
    )
    tokenizers = Tokenizers(byte_bpe, piece_model)
    width, same = len(tokenizers.bytes_b), tokenizers.same

    partial = aligned.select("same", "same_n", "pairs", "pairs_n").mapInArrow(
        _link_counts(len(same)), "same boolean, key long, n long"
    )
    counts = staged(partial.groupBy("same", "key").agg(F.sum("n").alias("n")), "link_counts")
    pairs = counts.where(~F.col("same")).select(F.col("key").alias("pair"), "n")
    # Neither of these is longer than a vocabulary.
    vector, best = np.zeros(len(same), np.int64), np.zeros(width, np.int64)
    for row in counts.where("same").collect():
        vector[row.key] = row.n
        best[same[row.key]] = max(best[same[row.key]], row.n)
    partner = (F.col("pair") % width).alias("b")
    for row in pairs.groupBy(partner).agg(F.max("n").alias("n")).collect():
        best[row.b] = max(best[row.b], row.n)

    links = pairs.agg(F.sum("n")).first()[0] or 0
    hot = pairs.where(F.col("n") >= F.ceil(F.lit(links) / F.lit(params.hot_pairs))).toPandas().sort_values("pair")
    send = spark.sparkContext.broadcast
    shared = [send(x) for x in (same, hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64))]
    kinds = f"_row long, _id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
    summed = staged(
        aligned.mapInArrow(
            _summed(vector, best, *shared, width),
            kinds + "n_best long, count_sum long, rare array<long>, rare_n array<long>",
        ),
        "summed",
    )
    most = spark.createDataFrame([(i, int(n)) for i, n in enumerate(best)], "b long, most long")
    judged = pairs.join(F.broadcast(most), partner == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    rare = summed.select("_row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select(
        "_row", F.col("x.rare").alias("pair"), F.col("x.rare_n").alias("times")
    )
    more = (
        rare.join(judged, "pair")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.col("n")).alias("more"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        )
    )
    whole = summed.join(more, "_row", "left")
    return whole.select(
        F.col("_id").alias(id),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
