"""Near-duplicate vectors by sorted projection passes.

In a pass every vector gets the sign bits of random projections, concatenated;
vectors are sorted by label and bits and compared with the next ``window`` ones.
Passes use other projections, so a pair that one pass parts is found by another;
the pairs that hold in double precision are united into components. Then each
component is compared with itself in blocks, which counts all of a vector's
links whatever the windows saw, without a row for each pair.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.llm.common import connected_components
from crivo.sources.tables import staged


@dataclass(frozen=True)
class VectorParams:
    """``block``: vectors of a component that one task holds on either side."""

    cosine: float = 0.98
    passes: int = 12
    window: int = 48
    bits: int = 63
    seed: int = 7
    block: int = 1024


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled by the largest part first, so that squares neither vanish nor overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _keys(params: VectorParams, number: int) -> Callable:
    def keys(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            group, vector = batch.column(1), batch.column(2)
            if not batch.num_rows:
                continue
            sizes = np.asarray(vector.value_lengths())
            bits = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes):
                if size not in planes:
                    chance = np.random.default_rng((params.seed, number, int(size)))
                    planes[size] = chance.standard_normal((int(size), params.bits))
                mine = np.flatnonzero(sizes == size)
                signs = _unit(_matrix(vector.take(pa.array(mine)))) @ planes[size] > 0
                bits[mine] = signs @ (1 << np.arange(params.bits - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), group, vector, pa.array(bits)], ["vec", "kind", "vector", "bits"]
            )

    return keys


def _near(kind, vectors: list[np.ndarray], params: VectorParams, window: int, first: int = 0):
    """Index pairs up to ``window`` apart, of one kind, that reach the cosine;
    the earlier index below ``first`` if that is set."""
    pairs = []
    lengths = np.array([len(v) for v in vectors])
    if (lengths != lengths[0]).any():
        for size in np.unique(lengths):
            mine = np.flatnonzero(lengths == size)
            for a, b in _near(kind[mine], [vectors[i] for i in mine], params, window):
                if not first or (mine[a] < first <= mine[b]):
                    pairs.append((mine[a], mine[b]))
        return pairs
    rows = _unit(np.array(vectors, np.float64))
    for gap in range(1, min(window, len(rows) - 1) + 1):
        same = kind[gap:] == kind[:-gap]
        near = np.einsum("ij,ij->i", rows[gap:], rows[:-gap]) >= params.cosine
        for a in np.flatnonzero(same & near):
            if not first or a < first <= a + gap:
                pairs.append((a, a + gap))
    return pairs


_PAIRS = "part long, side long, place long, a long, b long, kind string, vector array<double>"


def _windows(params: VectorParams) -> Callable:
    """Compare sorted rows within a partition. Each partition also passes on its
    first and last rows, for comparison across its ends."""

    def windows(batches):
        part, number = TaskContext.get().partitionId(), 0
        held_ids, held_kinds, held = np.empty(0, np.int64), np.empty(0, object), []

        def ends(side, ids, kinds, vectors, places):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part + side)),
                    pa.array(np.full(n, side)),
                    pa.array(places, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.array(kinds, pa.string()),
                    pa.array([list(v) for v in vectors], pa.list_(pa.float64())),
                ],
                _names(_PAIRS),
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                rows = batch.slice(start, 4096)
                ids = np.r_[held_ids, rows.column(0).to_numpy()]
                kinds = np.r_[held_kinds, np.array(rows.column(1).to_pylist(), object)]
                vectors = held + [np.asarray(v.values, np.float64) for v in rows.column(2)]
                old = len(held_ids)
                if number < params.window:
                    n = min(params.window - number, rows.num_rows)
                    yield ends(0, ids[old:][:n], kinds[old:][:n], vectors[old:][:n], range(number, number + n))
                number += rows.num_rows
                found = [(a, b) for a, b in _near(kinds, vectors, params, params.window) if b >= old]
                if found:
                    a, b = (ids[list(x)] for x in zip(*found))
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.nulls(n, pa.int64()),
                            pa.nulls(n, pa.int64()),
                            pa.nulls(n, pa.int64()),
                            pa.array(np.minimum(a, b)),
                            pa.array(np.maximum(a, b)),
                            pa.nulls(n, pa.string()),
                            pa.nulls(n, pa.list_(pa.float64())),
                        ],
                        _names(_PAIRS),
                    )
                held_ids, kinds = ids[-params.window :], kinds[-params.window :]
                held_kinds, held = kinds, vectors[-params.window :]
        if number:
            yield ends(1, held_ids, held_kinds, held, range(-len(held), 0))

    return windows


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _across(params: VectorParams) -> Callable:
    def across(group: pa.Table) -> pa.Table:
        group = group.sort_by([("side", "descending"), ("place", "ascending")])
        ids, sides = group["a"].to_numpy(), group["side"].to_numpy()
        first = int((sides == 1).sum())
        found = []
        if 0 < first < len(ids):
            kinds = np.array(group["kind"].to_pylist(), object)
            vectors = [np.asarray(v.values, np.float64) for v in group["vector"].combine_chunks()]
            found = _near(kinds, vectors, params, params.window, first)
        a, b = ids[[x[0] for x in found]], ids[[x[1] for x in found]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return across


def _links(params: VectorParams) -> Callable:
    def links(keys, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left["vec"].to_numpy(), right["vec"].to_numpy()
        counts = np.zeros(len(a), np.int64)
        groups = [t["component"].to_numpy() for t in (left, right)]
        sizes = [np.asarray(t["vector"].combine_chunks().value_lengths()) for t in (left, right)]
        for size in np.intersect1d(*sizes):
            x, y = np.flatnonzero(sizes[0] == size), np.flatnonzero(sizes[1] == size)
            one = _unit(_matrix(left["vector"].combine_chunks().take(pa.array(x))))
            two = _unit(_matrix(right["vector"].combine_chunks().take(pa.array(y))))
            near = one @ two.T >= params.cosine
            near &= (a[x][:, None] != b[y][None, :]) & (groups[0][x][:, None] == groups[1][y][None, :])
            counts[x] += near.sum(axis=1)
        return pa.table({"vec": a, "n": counts})

    return links


def vector_components(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    params: VectorParams = VectorParams(),
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``.

    Vectors of one label link when their cosine is at least ``params.cosine``.
    Null labels, and vectors that are null, empty or zero or hold null or
    non-finite parts, link with nothing; neither do vectors of unlike length.
    The component is the smallest vec_id reachable by links, ``kept`` is true
    for that one. Repeated rows count once and are answered alike; other rows
    with one id are one node, with the links of all of them and none to each
    other. A null id links with nothing.
    """
    parts = F.col(vector)
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec"),
        F.col(label).cast("string").alias("kind"),
        parts.cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    usable = staged(
        rows.where(
            F.col("vec").isNotNull() & F.col("kind").isNotNull() & F.coalesce(finite, F.lit(False))
        ).dropDuplicates(),
        "vectors",
    )
    pairs = []
    for number in range(params.passes):
        keyed = usable.mapInArrow(
            _keys(params, number), "vec long, kind string, vector array<double>, bits long"
        )
        # The rows of one pass are ranged over as many tasks as a shuffle has.
        ordered = keyed.repartitionByRange("kind", "bits", "vec").sortWithinPartitions("kind", "bits", "vec")
        found = staged(
            ordered.select("vec", "kind", "vector").mapInArrow(_windows(params), _PAIRS), "pass"
        )
        pairs.append(found.where("part IS NULL").select("a", "b"))
        pairs.append(
            found.where("part IS NOT NULL").groupBy("part").applyInArrow(_across(params), "a long, b long")
        )
    edges = pairs[0]
    for more in pairs[1:]:
        edges = edges.unionByName(more)
    components = staged(
        connected_components(edges, "a", "b").withColumnsRenamed({"node": "vec"}), "components"
    )
    # A large component is cut into blocks, how many follows from its size, and
    # all pairs of blocks are compared. Small ones share a cell, where rows of
    # one component meet. So a group has about params.block rows on either side.
    sizes = components.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / params.block).alias("blocks"))
    members = usable.join(components, "vec").join(staged(sizes, "sizes"), "component")
    cells = max(1, -(-2 * components.count() // params.block))
    members = staged(
        members.select(
            "component",
            "blocks",
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(cells)))
            .otherwise(F.col("component"))
            .alias("cell"),
            F.pmod(F.xxhash64("vec"), F.col("blocks")).alias("block"),
            "vec",
            "vector",
        ),
        "members",
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    meet = [(F.col("blocks") == 1).alias("small"), "cell"]
    both = ["component", "vec", "vector"]
    left = members.select(*meet, F.col("block").alias("i"), every.alias("j"), *both)
    right = members.select(*meet, every.alias("i"), F.col("block").alias("j"), *both)
    counted = (
        left.groupBy("small", "cell", "i", "j")
        .cogroup(right.groupBy("small", "cell", "i", "j"))
        .applyInArrow(_links(params), "vec long, n long")
        .groupBy("vec")
        .agg(F.sum("n").alias("n_links"))
    )
    found = staged(counted.join(components, "vec"), "counted")
    return rows.select("vec").join(found, "vec", "left").select(
        F.col("vec").alias("vec_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "vec").alias("component_id"),
        F.coalesce(F.col("vec") == F.coalesce("component", "vec"), F.lit(False)).alias("kept"),
    )
