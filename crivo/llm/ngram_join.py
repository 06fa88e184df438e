"""N-gram Jaccard join by vertical partitioning.

A document's set are the hashes of its distinct word n-grams. All grams have one
global order: grams of rare buckets before grams of frequent ones, then by
hash. The order is cut into fragments of about equally many grams, so a document
is cut into segments, one for each fragment. The overlap of two documents is
counted segment by segment and summed.

Which pairs are counted follows from the order: two sets that reach the
threshold share a gram among the first ``n - ceil(t * n) + 1`` grams of each.
Only those are shuffled, and those that one text alone has go first.

No group of documents with a gram is expanded into pairs. The group's hub is the
document with the fewest grams that it has alone, and a document is compared with
the hub it shares most with; what links is one component. Documents that stay
outside get a hub among themselves once more. After that only pairs of
different components are left, and of those only the ones in which a document is
outside the hub's component. Both steps drop pairs whose shared grams cannot
reach the threshold any more; the last one judges by bits of both fronts which pairs
cannot before it makes a row of them. So components are those of all pairs, and no cap
is needed.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from crivo.llm.common import (
    WORD_BYTES,
    by_row,
    connected_components,
    distinct_in_rows,
    mix,
    ngrams,
    text_chunks,
    words_of,
)
from crivo.sources.tables import scratch, staged

_SIGNS = ["sign_0", "sign_1"]


@dataclass(frozen=True)
class JoinParams:
    """``percent``: a pair links from this Jaccard similarity on, exactly.
    ``order_buckets``: gram frequencies are counted in 2^so many buckets; more
    of them tell frequent grams apart in a larger corpus, results don't change.
    ``fragments``: parts of the global order. ``group_rows``: rows of one gram
    that one task may look through; more are spread over several. ``hub_rounds``:
    how often sets are compared with a hub before pairs are; results don't
    change."""

    words: int = 5
    percent: int = 80
    order_buckets: int = 20
    fragments: int = 8
    group_rows: int = 1 << 16
    hub_rounds: int = 2


class GramOrder:
    """Frequency level and fragment of each bucket of grams."""

    def __init__(self, counts: np.ndarray, params: JoinParams):
        self.shift = np.uint64(64 - params.order_buckets)
        self.level = (16 * np.log2(np.maximum(counts, 1))).astype(np.uint16)
        order = np.lexsort((np.arange(len(counts)), self.level))
        share = np.cumsum(counts[order]) / max(1, counts.sum())
        self.fragment = np.empty(len(counts), np.int8)
        self.fragment[order] = np.minimum(
            np.floor(share * params.fragments * 0.999999), params.fragments - 1
        )
        self.salts = 1 + counts // params.group_rows

    def bucket(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> self.shift).astype(np.int64)

    def slot(self, grams: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The gram, or for a frequent one the part of its rows a key falls in."""
        salts = self.salts[self.bucket(grams)].astype(np.uint64)
        return grams ^ (mix(keys) % np.minimum(salts, np.uint64(1 << 20)))

    #: ``slot`` changes only low bits, so it also leads back.
    gram = slot


def gram_sets(
    batches: Iterator[pa.RecordBatch], text: str, n: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: rows, their distinct grams with the row of each, set size and
    key of each row. Rows with one set have one key."""
    for rows, data, offsets in text_chunks(batches, text, WORD_BYTES):
        words, of = words_of(data, offsets)[:2]
        grams, of = distinct_in_rows(*ngrams(words, of, n))
        sizes = np.bincount(of, minlength=rows.num_rows)
        keys = np.zeros(rows.num_rows, np.uint64)
        full = np.flatnonzero(sizes)
        if len(full):
            begin = (np.cumsum(sizes) - sizes)[full]
            sums = np.add.reduceat(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), begin)
            keys[full] = mix(sums + np.bitwise_xor.reduceat(grams, begin))
        yield rows, grams, of, sizes, keys


def _longs(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {k: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v, pa.int64()) for k, v in columns.items()}
    )


def _count_buckets(text: str, params: JoinParams) -> Callable:
    def count(batches):
        total = np.zeros(1 << params.order_buckets, np.int64)
        shift = np.uint64(64 - params.order_buckets)
        held, size = [], 0
        for _, grams, _, _, _ in gram_sets(batches, text, params.words):
            held.append((grams >> shift).astype(np.int64))
            size += len(grams)
            if size > len(total):
                total += np.bincount(np.concatenate(held), minlength=len(total))
                held, size = [], 0
        if size:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        found = np.flatnonzero(total)
        yield _longs(bucket=found, n=total[found])

    return count


def _sets(doc_id: str, text: str, params: JoinParams) -> Callable:
    def sets(batches):
        for rows, _, _, sizes, keys in gram_sets(batches, text, params.words):
            ids = rows.column(rows.schema.get_field_index(doc_id)).cast(pa.int64())
            found = _longs(key=keys, n=sizes)
            yield pa.RecordBatch.from_arrays([ids, *found.columns], ["id", "key", "n"])

    return sets


def _prefixes(text: str, params: JoinParams, order) -> Callable:
    def prefixes(batches):
        ranks = order.value
        for _, grams, of, sizes, keys in gram_sets(batches, text, params.words):
            if not len(grams):
                continue
            # Rows come by row and hash; the level goes in between.
            by = by_row(np.argsort(ranks.level[ranks.bucket(grams)], kind="stable"), of)
            place = np.arange(len(grams)) - (np.cumsum(sizes) - sizes)[of]
            n = sizes[of]
            front = place < n - (params.percent * n + 99) // 100 + 1
            grams, key, n, place = grams[by][front], keys[of][front], n[front], place[front]
            yield _longs(slot=ranks.slot(grams, key), key=key, place=(place << 32) | n)

    return prefixes


def _shared(order) -> Callable:
    """Of rows sorted by slot and key: one for each slot and key, where a slot
    has several keys or is only part of a gram's. Holds one batch and the last
    row before it."""

    def shared(batches):
        ranks = order.value
        last = None  # slot, key, place, whether it has gone out
        for batch in batches:
            slot, key, place = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            gone = False
            if last is not None:
                slot, key, place = (np.r_[x, y] for x, y in zip(last[:3], (slot, key, place)))
                gone = last[3]
            if not len(slot):
                continue
            new = np.r_[True, (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])]
            slot, key, place = slot[new], key[new], place[new]
            same = slot[1:] == slot[:-1]
            grams = ranks.gram(slot.view(np.uint64), key.view(np.uint64))
            out = np.r_[gone, same] | np.r_[same, False] | (ranks.salts[ranks.bucket(grams)] > 1)
            last = (slot[-1:], key[-1:], place[-1:], bool(out[-1]))
            if gone:
                out[0] = False
            yield _longs(
                gram=grams[out], key=key[out], place=place[out] >> 32, n=place[out] & 0xFFFFFFFF
            )

    return shared


def _segments(text: str, params: JoinParams, order, wanted) -> Callable:
    def segments(batches):
        ranks, bits, seen = order.value, wanted.value, set()
        for _, grams, of, sizes, keys in gram_sets(batches, text, params.words):
            rows = np.flatnonzero(in_filter(bits, keys) & (sizes > 0))
            rows = np.array([r for r in rows if (k := int(keys[r])) not in seen and not seen.add(k)], np.int64)
            mine = np.zeros(len(sizes), bool)
            mine[rows] = True
            grams, of = grams[mine[of]], of[mine[of]]
            if not len(grams):
                continue
            part = ranks.fragment[ranks.bucket(grams)]
            by = by_row(np.argsort(part, kind="stable"), of)
            grams, of, part = grams[by], of[by], part[by].astype(np.int64)
            cut = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (part[1:] != part[:-1])])
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[cut, len(grams)], pa.int32()), pa.array(grams.view(np.int64))
            )
            found = _longs(key=keys[of[cut]], part=part[cut])
            yield pa.RecordBatch.from_arrays([*found.columns, lists], ["key", "part", "grams"])

    return segments


# A fixed number of bits, so that what each task gets does not grow with the
# data. When it fills up, documents that aren't wanted pass too and meet no pair.
FILTER_BITS = 24


def filter_bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = mix(keys + np.uint64(1))
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return keys & mask, (keys >> np.uint64(32)) & mask


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for at in filter_bits(keys):
        found &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    return found


def _bit_words(batches):
    for batch in batches:
        at = np.concatenate(filter_bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
        word, value = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
        yield _longs(word=word, bits=value)


def _filter_of(keys: DataFrame):
    words = keys.mapInArrow(_bit_words, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found = words.toArrow()
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def _reaches(percent: int, a: str, b: str) -> Column:
    """Whether two sets that share the gram of rows a and b can still link.

    Before the gram they share at most the grams that either has seen shared,
    behind it at most what the shorter rest holds."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = (
        F.least(f"{a}.before", f"{b}.before")
        + 1
        + F.least(na - F.col(f"{a}.place") - 1, nb - F.col(f"{b}.place") - 1)
    )
    return (
        (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)
        & (most * (100 + percent) >= (na + nb) * percent)
    )


def _linked(pairs: DataFrame, docs: DataFrame, text: str, params: JoinParams, order) -> DataFrame:
    """Those of the pairs that reach the threshold: overlaps of segments, summed.

    Segments of ``b`` go to those of ``a``, which may have very many partners;
    both come from one table, so that texts are read once for both sides and
    adaptive execution can split large ones.
    """
    wanted = _filter_of(pairs.select("a").union(pairs.select("b")).distinct())
    found = docs.select(text).mapInArrow(
        _segments(text, params, order, wanted), "key long, part long, grams array<long>"
    )
    segments = staged(found.dropDuplicates(["key", "part"]), "segments")
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(params.fragments - 1).cast("long")))
    overlaps = (
        pairs.withColumn("part", part)
        .join(segments.toDF("b", "part", "right"), ["b", "part"])
        .join(segments.toDF("a", "part", "left"), ["a", "part"])
    )
    return (
        overlaps.groupBy("a", "b", "na", "nb")
        .agg(F.sum(F.size(F.array_intersect("left", "right"))).alias("overlap"))
        .where(F.col("overlap") * (100 + params.percent) >= (F.col("na") + F.col("nb")) * params.percent)
        .select("a", "b")
    )


def _best_hubs(rows: DataFrame, hubs: DataFrame, params: JoinParams) -> DataFrame:
    """(a, na, b, nb): each set b with that of its hubs it shares most with, of
    those in other components."""
    return (
        rows.alias("x")
        .join(hubs.alias("h"), F.col("x.gram") == F.col("h.gram"))
        .where(
            (F.col("x.key") != F.col("h.key"))
            & (F.col("x.component") != F.col("h.component"))
            & _reaches(params.percent, "x", "h")
        )
        .groupBy(
            F.col("h.key").alias("a"), F.col("h.n").alias("na"), F.col("x.key").alias("b"), F.col("x.n").alias("nb")
        )
        .agg(F.count(F.lit(1)).alias("shared"))
        .groupBy("b", "nb")
        .agg(F.max(F.struct("shared", "a", "na")).alias("best"))
        .select("best.a", "best.na", "b", "nb")
    )


def _enough_shared(percent: int, shared: Column, na: Column, nb: Column) -> Column:
    """Whether a pair that shares ``shared`` grams of both fronts can link.

    Of the front that ends first in the order all common grams are counted;
    behind it there are at most the set's other grams."""
    need = F.ceil((na + nb) * percent / (100 + percent))
    return shared >= need - F.ceil(F.greatest(na, nb) * percent / 100) + 1


def _signs(of_set: WindowSpec) -> dict[str, Column]:
    """Two columns of 64 bits, one of which is set for each gram of a front."""
    bit = F.expr("shiftleft(1L, cast(gram & 63 as int))")
    half = F.shiftright("gram", 6).bitwiseAND(1)
    return {s: F.bit_or(F.when(half == i, bit).otherwise(0)).over(of_set) for i, s in enumerate(_SIGNS)}


def _most_shared(a: str, b: str) -> Column:
    """No fewer than the grams that the fronts of rows a and b share: a bit that
    only one of them has stands for a gram, at least, that the other lacks."""

    def left(one: str, other: str) -> Column:
        lacking = (F.bit_count(F.col(f"{one}.{s}").bitwiseAND(F.bitwise_not(f"{other}.{s}"))) for s in _SIGNS)
        return reduce(lambda n, lacks: n - lacks, lacking, F.col(f"{one}.common"))

    return F.least(left(a, b), left(b, a))


def ngram_jaccard_components(
    docs: DataFrame, doc_id: str, text: str, params: JoinParams = JoinParams()
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    Words are runs without white space (bytes 9-13 and 32), A-Z lower-cased. A
    text with fewer words than ``params.words`` has its whole sequence as one
    gram; null, empty and blank texts have none and link with nothing. The
    component is the smallest id reachable by links. Rows with an equal set
    link, whatever their ids: repeated rows give repeated results, a null id
    joins its component without naming it and is null where nothing else does.
    Other columns are not read.
    """
    with scratch(docs.sparkSession):
        rows, least = _members(docs.select(doc_id, text), doc_id, text, params)
    return rows.join(least, "component", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )


def _members(docs: DataFrame, doc_id: str, text: str, params: JoinParams) -> tuple[DataFrame, DataFrame]:
    """Rows with their component, and the smallest id of each component."""
    spark = docs.sparkSession
    only = docs.select(text)
    counts = np.zeros(1 << params.order_buckets, np.int64)
    found = (
        only.mapInArrow(_count_buckets(text, params), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    order = spark.sparkContext.broadcast(GramOrder(counts, params))

    sets = staged(docs.mapInArrow(_sets(doc_id, text, params), "id long, key long, n long"), "sets")
    fronts = (
        only.mapInArrow(_prefixes(text, params, order), "slot long, key long, place long")
        .repartition("slot")
        .sortWithinPartitions("slot", "key")
        .mapInArrow(_shared(order), "gram long, key long, place long, n long")
    )
    of_set = Window.partitionBy("key")
    before = F.row_number().over(of_set.orderBy("place")) - 1
    common = F.count(F.lit(1)).over(of_set)
    fronts = staged(fronts.withColumns({"before": before, "common": common, **_signs(of_set)}), "fronts")
    # The fewer grams of its front no other set has, the more a set can link with.
    alone = (F.col("n") - F.ceil(F.col("n") * params.percent / 100) + 1 - F.col("common")).alias("alone")
    front = F.struct(alone, "place", "key", "n", "before", "component")
    component = F.coalesce("component", "key")
    placed = fronts.withColumn("component", F.col("key"))
    outside, centre, compared, links = placed, None, None, None
    # Sets outside the component of their group's hub get a hub among themselves,
    # as that of a second group whose texts are near each other.
    for _ in range(params.hub_rounds):
        hubs = staged(
            outside.groupBy("gram").agg(F.min(front).alias("hub")).select("gram", "hub.*"), "hubs"
        )
        with_hub = staged(_best_hubs(outside, hubs, params), "with_hub")
        found = staged(_linked(with_hub, docs, text, params, order), "linked")
        compared = with_hub if compared is None else compared.union(with_hub)
        links = found if links is None else links.union(found)
        parts = connected_components(links, "a", "b").withColumnRenamed("node", "key")
        placed = staged(fronts.join(parts, "key", "left").withColumn("component", component), "placed")
        centre = hubs.select("gram", "key") if centre is None else centre
        centres = centre.join(parts, "key", "left").select("gram", component.alias("centre"))
        outside = staged(
            placed.join(staged(centres, "centres"), "gram").where("component != centre"), "outside"
        )
        if outside.isEmpty():
            break
    beside = placed.join(outside.select("gram").distinct(), "gram", "left_semi")
    x_first = F.col("x.key") < F.col("y.key")

    def one(column: str, first: Column) -> Column:
        return F.when(first, F.col(f"x.{column}")).otherwise(F.col(f"y.{column}"))

    rest = (
        outside.alias("x")
        .join(beside.alias("y"), F.col("x.gram") == F.col("y.gram"))
        .where(
            (F.col("x.component") != F.col("y.component"))
            & ((F.col("y.component") == F.col("x.centre")) | x_first)
            & _reaches(params.percent, "x", "y")
            & _enough_shared(params.percent, _most_shared("x", "y"), F.col("x.n"), F.col("y.n"))
        )
        .groupBy(
            one("key", x_first).alias("a"),
            one("n", x_first).alias("na"),
            one("key", ~x_first).alias("b"),
            one("n", ~x_first).alias("nb"),
        )
        .agg(F.count(F.lit(1)).alias("shared"))
        .where(_enough_shared(params.percent, F.col("shared"), F.col("na"), F.col("nb")))
        .join(
            compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
            ["a", "b"],
            "left_anti",
        )
    )
    rest = staged(rest.drop("shared"), "rest")
    if not rest.isEmpty():
        links = links.union(_linked(rest, docs, text, params, order))
        parts = connected_components(links, "a", "b").withColumnRenamed("node", "key")

    rows = sets.join(parts, "key", "left").withColumn("component", component)
    rows = staged(rows, "members", result=True)
    least = rows.where("n > 0").groupBy("component").agg(F.min("id").alias("least"))
    return rows, staged(least, "least", result=True)
