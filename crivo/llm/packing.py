"""Packing by lexical retrieval: similar documents share a sequence.

Documents are dealt to shards by a min-hash of their words, so that texts with
common passages tend to meet; a shard with too many is split. Each shard has an
inverted index with BM25 weights, the document frequencies of which come from
the whole corpus. A seed document opens a sequence; the best unused neighbour
that the index returns for all of its terms follows, and adds its own terms to
the query, until the last one is cut. What is left of that one is the next seed,
so nothing but the last sequence of a shard is padded.
"""

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.llm.common import WORD_BYTES, mix, text_chunks, words_of
from crivo.llm.units import gather


@dataclass(frozen=True)
class PackParams:
    """``shard_bytes`` of text in about ``shard_rows`` rows are indexed at a time;
    a single longer text is a shard of its own. Document frequencies are counted
    in ``1 << term_bits`` buckets of terms. ``end_id`` follows every document."""

    length: int = 2048
    end_id: int = 1
    shard_bytes: int = 8 << 20
    shard_rows: int = 8192
    shards: int = 4096
    term_bits: int = 18
    k1: float = 1.2
    b: float = 0.75


# Fixed value: where byte-level files split a text. Possessive, so that the
# search for a part never goes back.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def byte_bpe_encoder(data: bytes) -> Callable[[str], np.ndarray]:
    """Ids of a text by a byte-level BPE tokenizer file, without special tokens.

    The file's vocabulary is read into tiktoken, which gives the same ids
    several times as fast, as long as ids follow the order of merges; else the
    file's own library encodes.
    """
    if (ranks := _ranks(data)) is not None:
        import tiktoken

        fast = tiktoken.Encoding("ranked", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda text: fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    # Their strings in a text are ordinary text.
    tokenizer.encode_special_tokens = True
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32)


def _ranks(data: bytes) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if those are ranks of merges."""
    model = json.loads(data)["model"]
    # Byte-level files write bytes as printable characters: those that are none
    # get the characters from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(plain))
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [model["vocab"].get(a + b, -1) for a, b in merges]
    if not merged or min(merged) < 256 or merged != sorted(merged):
        return None
    named = {t: i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
    return {bytes(byte_of[c] for c in t): i for t, i in named.items() if i <= merged[-1]}


# A blank begins a part of its own unless other white space is beside it. Texts
# with such blanks are encoded whole.
_BESIDE = r"[\s\x0b\x{85}\p{Z}] | [\s\x0b\x{85}\p{Z}]"
_BLANK_END = r"^$|[\s\x0b\x{85}\p{Z}]$"


class ColumnEncoder:
    """Ids of whole columns, as ``byte_bpe_encoder`` gives them for each text.

    Distinct words behind a blank are encoded as one text; the bytes of its tokens
    tell whose they are."""

    def __init__(self, data: bytes):
        self.one, ranks = byte_bpe_encoder(data), _ranks(data)
        # How another file parts its texts is not known.
        self.whole = _BESIDE if ranks else r"(?s)."
        self.widths = np.zeros(max(ranks.values()) + 1 if ranks else 0, np.int64)
        for token, i in (ranks or {}).items():
            self.widths[i] = len(token)

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the n+1 offsets of rows in them; null is empty."""
        texts = texts.fill_null("")
        whole = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~whole & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        first = np.asarray(lists.offsets)[:-1] - (lists.offsets[0].as_py() if len(plain) else 0)
        numbered = lists.flatten().dictionary_encode()
        # A word's number, doubled, and one more behind a blank.
        codes = numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + 1
        codes[first] -= 1
        ids, starts, width = self._words(numbered.dictionary, codes)
        sizes = np.zeros(len(texts), np.int64)
        if len(plain):
            sizes[plain] = np.add.reduceat(width[codes], first)
        parts = {row: self.one(texts[int(row)].as_py()) for row in np.flatnonzero(whole)}
        for row, found in parts.items():
            sizes[row] = len(found)
        offsets = np.r_[0, np.cumsum(sizes)]
        out = gather(ids, starts, width, codes)
        if parts:
            plain_ids, out = out, np.empty(int(offsets[-1]), np.int32)
            mine = np.ones(len(out), bool)
            for row, found in parts.items():
                out[offsets[row] : offsets[row + 1]] = found
                mine[offsets[row] : offsets[row + 1]] = False
            out[mine] = plain_ids
        return out, offsets

    def _words(self, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each code start and how many they are."""
        used = np.zeros(2 * len(words), bool)
        used[codes] = True
        joined = np.flatnonzero(used[1::2])
        # White space at the end of a text would go with the blank behind it.
        among = words.take(pa.array(joined))
        apart = pc.match_substring_regex(among, _BLANK_END)
        joined, among = joined[~apart.to_numpy(zero_copy_only=False)], among.filter(pc.invert(apart))
        used[2 * joined + 1] = False
        parts = [self.one(" ".join(["", *among.to_pylist()]))]
        ends = np.cumsum(pc.binary_length(among).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        width = np.zeros(2 * len(words), np.int64)
        cuts = np.searchsorted(np.cumsum(self.widths[parts[0]]), ends, "right")
        width[2 * joined + 1] = np.diff(cuts, prepend=0)
        others = np.flatnonzero(used)
        parts += [self.one((" " if c & 1 else "") + words[c >> 1].as_py()) for c in others.tolist()]
        width[others] = [len(p) for p in parts[1:]]
        order = np.r_[2 * joined + 1, others]
        starts = np.zeros(2 * len(words), np.int64)
        starts[order] = np.cumsum(width[order]) - width[order]
        return np.concatenate(parts), starts, width


_loaded: dict[int, ColumnEncoder] = {}


def _encoder(data: bytes) -> ColumnEncoder:
    key = hash(data)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ColumnEncoder(data)
    return _loaded[key]


def _terms(data: np.ndarray, offsets: np.ndarray, bits: int):
    words, rows = words_of(data, offsets)[:2]
    return words, (words & np.uint64((1 << bits) - 1)).astype(np.int64), rows


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, worked out a chunk at a time."""
    words, of, start = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + WORD_BYTES, "right")) - 1
        part = offsets[start : max(end, start + 1) + 1]
        found, rows = words_of(data[part[0] : part[-1]], part - part[0])[:2]
        words.append(found)
        of.append(rows + start)
        start += len(part) - 1
    return np.concatenate(words), np.concatenate(of)


def _frequencies(params: PackParams) -> Callable:
    def count(batches):
        total, mask = np.zeros((1 << params.term_bits) + 2, np.int64), (1 << params.term_bits) - 1
        held, size = [], 0
        for rows, data, offsets in text_chunks(batches, "_text", WORD_BYTES):
            _, terms, of = _terms(data, offsets, params.term_bits)
            total[-2:] += rows.num_rows, len(terms)
            # Each term of a row once. Values alone are sorted faster than their places.
            pairs = np.sort(of << params.term_bits | terms)
            held.append(pairs[np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)]] & mask)
            size += len(held[-1])
            if size > mask:
                total[:-2] += np.bincount(np.concatenate(held), minlength=mask + 1)
                held, size = [], 0
        if size:
            total[:-2] += np.bincount(np.concatenate(held), minlength=mask + 1)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "n"])

    return count


def _signed(params: PackParams) -> Callable:
    """Each row with the smallest hash of its words."""

    def signed(batches):
        for rows, data, offsets in text_chunks(batches, "_text", WORD_BYTES):
            words, _, of = _terms(data, offsets, params.term_bits)
            least = np.zeros(rows.num_rows, np.uint64)
            if len(words):
                first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                least[of[first]] = np.minimum.reduceat(mix(words), first)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(least.view(np.int64))], ["_id", "_text", "_near"]
            )

    return signed


class Shard:
    """Documents with an inverted index, packed in order of their arrival."""

    def __init__(self, data, offsets, ids, starts, statistics, params: PackParams):
        self.params, self.ids, self.starts = params, ids, starts
        self.left = np.diff(starts)  # tokens of each document not yet packed
        self.done = np.zeros(len(self.left), np.int64)
        words, of = _words(data, offsets)
        # Distinct words by hash, and each word's place among them.
        numbered = pa.array(words).dictionary_encode()
        known = numbered.dictionary.to_numpy(zero_copy_only=False)
        rank = np.empty(len(known), np.int64)
        rank[np.argsort(known)] = np.arange(len(known))
        # Values alone are sorted faster than their places.
        pairs = np.sort(of * len(known) + rank[numbered.indices.to_numpy()])
        new = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)])
        times = np.diff(np.r_[new, len(pairs)])
        of, word = np.divmod(pairs[new], max(1, len(known)))
        frequency, documents, mean = statistics
        seen = frequency[(np.sort(known) & np.uint64((1 << params.term_bits) - 1)).astype(np.int64)]
        idf = np.log1p((documents - seen + 0.5) / (seen + 0.5))[word]
        size = np.bincount(of, times, minlength=len(self.left))[of]
        norm = params.k1 * (1 - params.b + params.b * size / mean)
        weight = idf * times * (params.k1 + 1) / (times + norm)
        # Terms are whole hashes, numbered as they lie. By term: the documents that
        # have it; a term of one document finds nobody and is left out.
        by = np.sort(word << 32 | np.arange(len(word))) & 0xFFFFFFFF
        first = np.r_[True, word[by[1:]] != word[by[:-1]]][: len(by)]
        several = ~(first & np.r_[first[1:], True][: len(by)])
        by, first = by[several], first[several]
        self.posted, self.posted_weight = of[by], weight[by]
        self.post_at = np.r_[np.flatnonzero(first), len(by)]
        # By document: the terms that it shares.
        name = np.full(len(of), -1, np.int64)
        name[by] = np.cumsum(first) - 1
        shared = name >= 0
        self.query_at = np.searchsorted(of[shared], np.arange(len(self.left) + 1))
        self.query_terms = name[shared]
        self.unused = self.posted_for = len(self.left)
        self.here = np.arange(len(self.left))  # the documents that postings number
        # Terms that a fourth of the documents have are rows of weights instead.
        sizes = np.diff(self.post_at)
        many = 4 * sizes >= len(self.left)
        self.row_of = np.where(many, np.cumsum(many) - 1, -1)
        self.rows = np.zeros((int(many.sum()), len(self.left)))
        moved = np.repeat(many, sizes)
        self.rows[np.repeat(self.row_of, sizes)[moved], self.posted[moved]] = self.posted_weight[moved]
        self._keep(~moved)

    def _keep(self, postings: np.ndarray) -> None:
        self.post_at = np.r_[0, np.cumsum(postings)][self.post_at]
        self.posted, self.posted_weight = self.posted[postings], self.posted_weight[postings]

    def scores(self, seed: int) -> np.ndarray:
        """Of every document as the answer to all terms that the seed shares with
        another; of use for those unused."""
        if 8 * self.unused < 7 * self.posted_for:
            # Postings of used documents go each time that an eighth of them is used.
            left = self.left[self.here] > 0
            self._keep(left[self.posted])
            self.posted = (np.cumsum(left) - 1)[self.posted]
            self.here, self.rows = self.here[left], self.rows[:, left]
            self.posted_for = self.unused
        terms = self.query_terms[self.query_at[seed] : self.query_at[seed + 1]]
        starts, sizes = self.post_at[terms], self.post_at[terms + 1] - self.post_at[terms]
        at = np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        found = np.bincount(self.posted[at], self.posted_weight[at], minlength=len(self.here)).astype(float)
        rows = self.row_of[terms]
        for row in rows[rows >= 0].tolist():
            found += self.rows[row]
        scores = np.zeros(len(self.left))
        scores[self.here] = found
        return scores

    def take(self, row: int, space: int) -> tuple[int, int, int]:
        size = int(min(space, self.left[row]))
        start = int(self.done[row])
        self.done[row] += size
        self.left[row] -= size
        self.unused -= bool(size) and not self.left[row]
        return row, start, size

    def sequences(self) -> Iterator[list[tuple[int, int, int]]]:
        """Lists of (row, start, length) that fill a sequence each."""
        length, following, cut = self.params.length, 0, None
        while True:
            while following < len(self.left) and not self.left[following]:
                following += 1
            if cut is not None and self.left[cut]:
                seed = cut
            elif following < len(self.left):
                seed = following
            else:
                return
            pieces, score = [self.take(seed, length)], np.zeros(len(self.left))
            space, cut = length - pieces[0][2], seed
            while space:
                # The index answers for all that the sequence holds, or a word that
                # many share would fill it with one of each group. When it knows no
                # one more, the next unused document follows.
                score += self.scores(cut)
                score[self.left == 0] = 0
                row = int(score.argmax())
                if not score[row]:
                    while following < len(self.left) and not self.left[following]:
                        following += 1
                    if following == len(self.left):
                        break
                    row = following
                pieces.append(self.take(row, space))
                space, cut = space - pieces[-1][2], row
            yield pieces


def _packed(params: PackParams, model, statistics, with_ids: bool) -> Callable:
    def packed(batches):
        encoder, sequence = _encoder(model.value), TaskContext.get().partitionId() << 32
        held: list = []
        size = count = 0

        def parts():
            nonlocal held, size, count
            for batch in batches:
                for rows, data, _ in text_chunks(iter([batch]), "_text"):
                    full = size + len(data) > params.shard_bytes or count + rows.num_rows > params.shard_rows
                    if held and full:
                        yield held
                        held, size, count = [], 0, 0
                    held.append(rows)
                    size, count = size + len(data), count + rows.num_rows
            if held:
                yield held

        for group in parts():
            table = pa.Table.from_batches(group).combine_chunks()
            rows, data, offsets = next(text_chunks(iter(table.to_batches()), "_text", 1 << 62))
            ids, starts = _with_end(encoder, rows.column(1), params.end_id)
            names = rows.column(0)
            out: dict[str, list] = {c: [] for c in ("row", "start", "length", "crc", "total", "seq", "at", "ids")}
            for pieces in Shard(data, offsets, ids, starts, statistics.value, params).sequences():
                at = 0
                for row, start, length in pieces:
                    a = starts[row] + start
                    found = ids[a : a + length]
                    values = (row, start, length, zlib.crc32(found.astype("<u4").tobytes()))
                    values += (starts[row + 1] - starts[row], sequence, at, found if with_ids else None)
                    for column, value in zip(out.values(), values):
                        column.append(value)
                    at += length
                sequence += 1
            columns = [names.take(pa.array(out["row"], pa.int64()))]
            columns += [pa.array(out[c], pa.int64()) for c in ("start", "length", "crc", "total", "seq", "at")]
            labels = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                labels.append("ids")
            yield pa.RecordBatch.from_arrays(columns, labels)

    return packed


def _with_end(encoder: ColumnEncoder, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows with the end id behind each, and the n+1 offsets."""
    found, offsets = encoder.rows(texts)
    starts = offsets + np.arange(len(offsets))
    ids = np.empty(len(found) + len(texts), np.int32)
    last = np.zeros(len(ids), bool)
    last[starts[1:] - 1] = True
    ids[last], ids[~last] = end, found
    return ids, starts


def pack_documents(
    docs: DataFrame,
    doc_id: str,
    text: str,
    tokenizer: bytes,
    params: PackParams = PackParams(),
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and its ``ids`` if wanted.

    ``tokenizer`` is the content of a byte-level BPE file. Pieces of a sequence
    lie end to end from offset 0; a sequence that is shorter than
    ``params.length`` is the last of its shard. A null or empty text is the end
    id alone. Repeated rows are packed each, null ids too. Sequence ids are
    unique within one run; a task that runs again packs alike, since its rows
    are sorted.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    found = (
        rows.select("_text")
        .mapInArrow(_frequencies(params), "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((1 << params.term_bits) + 2, np.int64)
    counts[found["term"].to_numpy()] = found["n"].to_numpy()
    documents = max(1, int(counts[-2]))
    statistics = spark.sparkContext.broadcast((counts[:-2], documents, max(1.0, counts[-1] / documents)))
    model = spark.sparkContext.broadcast(tokenizer)
    near = rows.mapInArrow(_signed(params), "_id long, _text string, _near long")
    shard = F.pmod(F.xxhash64("_near"), F.lit(params.shards)).alias("_shard")
    dealt = (
        near.select("*", shard)
        .hint("rebalance", "_shard")
        .sortWithinPartitions("_shard", "_near", "_id", "_text")
        .select("_id", "_text")
    )
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    if with_ids:
        schema += ", ids array<int>"
    return dealt.mapInArrow(_packed(params, model, statistics, with_ids), schema)
