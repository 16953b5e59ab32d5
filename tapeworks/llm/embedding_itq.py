"""Embedding near-dedup by iterative quantisation.

Rotations are learned under which the signs of a vector are a balanced binary code of CODE_BITS close to the vector
itself. Substrings of the code are the keys of multi-index Hamming tables: a vector stands in each table under its own
substring and, where the plan says so, asks under the keys that differ in one bit. Vectors that meet there are compared
by their original components, in double precision. Each pair counts once, in the first table in which its substrings
are near enough, which the codes themselves tell; a bucket gives counts and a spanning forest, never its pairs. Large
buckets are dealt out in blocks, so that all of them are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.skew import left_lookup
from tapeworks.llm.columns import prepared, stage
from tapeworks.llm.components import HOT_ROWS, smallest_member, with_roots
from tapeworks.llm.labelled import sampled

# Vectors that the rotations of a length are learned on at most, the first by a hash; all vectors are indexed.
TRAINING_VECTORS = 4_096
CODE_BITS = 256
KEY_BITS = range(4, 17)
# Rows that a vector may take in all tables.
ROWS_EACH = 40
# Probability that two vectors just at the least cosine meet in one of the planned tables.
RECALL = 0.995
# Members of a bucket that are compared in one block; larger buckets are dealt out.
BLOCK = 512
# Lengths with codes of their own, the commonest; vectors of other lengths are compared with all of their length.
CODED_LENGTHS = 8


@dataclass(frozen=True)
class Plan:
    """How many tables of how many bits, and in how many bits (0 or 1) keys that meet may differ."""

    tables: int
    bits: int
    radius: int = 0

    @property
    def rows(self) -> float:
        """Rows of a vector in all tables: its keys, and those with one bit less set."""
        return self.tables * (1 + self.radius * self.bits / 2)


@dataclass(frozen=True)
class Codes:
    """The learned rotations, as one matrix of projections with a column for each bit of the code."""

    mean: np.ndarray
    projections: np.ndarray
    plan: Plan

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The key of each vector in each table. What lies in a bit's border by rounding alone is on one side."""
        used = self.projections[:, : self.plan.tables * self.plan.bits]
        signs = unit @ used - self.mean @ used > 1e-9
        weights = 1 << np.arange(self.plan.bits)
        return (signs.reshape(len(unit), self.plan.tables, self.plan.bits) @ weights).astype(np.uint16)


def planned(unit: np.ndarray, rows: int, least: float) -> Plan | None:
    """The tables that find two vectors just at a cosine of ``least`` with a probability of RECALL; None if none can.

    Codes are of centred vectors, between which the angle is larger the nearer they are to the mean; that of a
    hundredth of the sample is larger still. Among the plans that the code is long enough for, and that keep to
    ROWS_EACH, the one with least work is taken: a row for each key, and the vectors in its bucket.
    """
    centred = unit - (unit.mean(axis=0) if len(unit) else 0)
    short = np.quantile((centred**2).sum(axis=1), 0.01) if len(unit) else 1.0
    cosine = max(-1.0, 1 - (1 - least) / max(short, 1e-9))
    agree = 1 - np.arccos(cosine) / np.pi
    best, work = None, np.inf
    for bits in KEY_BITS:
        for radius in (0, 1):
            together = agree**bits + radius * bits * (1 - agree) * agree ** (bits - 1)
            if together <= 1e-9:
                continue
            tables = 1 if together >= RECALL else int(np.ceil(np.log(1 - RECALL) / np.log1p(-together)))
            plan = Plan(tables, bits, radius)
            cost = plan.rows * (1 + rows * (1 + radius * bits / 2) / 2**bits / BLOCK)
            if tables * bits <= CODE_BITS and plan.rows <= ROWS_EACH and cost < work:
                best, work = plan, cost
    return best


def learned(unit: np.ndarray, plan: Plan, rounds: int = 30, seed: int = 5) -> Codes:
    """Rotations by iterative quantisation: codes and rotation are fitted to each other in turn, from random starts.

    As many are learned as give CODE_BITS bits; each table takes the next bits, in a random order of each rotation's.
    """
    dims = unit.shape[1]
    mean = unit.mean(axis=0) if len(unit) else np.zeros(dims)
    centred = unit - mean
    random = np.random.default_rng(seed)
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
    reduced = centred @ axes
    found = []
    for _ in range(-(-min(CODE_BITS, plan.tables * plan.bits) // dims)):
        rotation = np.linalg.qr(random.standard_normal((dims, dims)))[0]
        for _ in range(rounds if len(unit) else 0):
            signs = np.sign(reduced @ rotation)
            left, _, right = np.linalg.svd(signs.T @ reduced)
            rotation = (left @ right).T
        found.append((axes @ rotation)[:, random.permutation(dims)])
    return Codes(mean, np.hstack(found), plan)


def usable(vector: str) -> Column:
    """Whether a vector has only finite components, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(values: pa.Array, dims: int) -> np.ndarray:
    """Rows of unit length in double precision; components are scaled first, so none overflows."""
    x = np.asarray(values.flatten(), dtype=np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, initial=1e-300, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_in_block(left: tuple, right: tuple | None, table: int, least: float, radius: int = 0) -> list[tuple]:
    """(node, links, root) of a block: how many vectors each is linked to, and a smaller node it is linked with.

    A side is (nodes, unit vectors, keys, weights, asking); without a right side all pairs of the left one are meant,
    but for two that both ask under a key that is not theirs. Pairs whose keys were near enough in an earlier table
    are left out.
    """
    nodes, units, keys, weights, asking = left if right is None else (np.concatenate(x) for x in zip(left, right))
    cut = len(left[0])
    other = slice(None) if right is None else slice(cut, None)
    near = (units[:cut] @ units[other].T >= least) & ~(asking[:cut, None] & asking[None, other])
    if right is None:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if right is not None:
        j = j + cut
    for earlier in range(table):
        new = np.bitwise_count(keys[i, earlier] ^ keys[j, earlier]) > radius
        i, j = i[new], j[new]
    if not len(i):
        return []
    links = np.bincount(i, weights[j], len(nodes)) + np.bincount(j, weights[i], len(nodes))
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    order = np.argsort(nodes, kind="stable")
    rank = np.empty(len(nodes), dtype=np.int64)
    rank[order] = np.arange(len(nodes))
    # One pass of hooking each to its smallest neighbour leaves few pairs for the rest.
    low = np.arange(len(nodes))
    np.minimum.at(low, rank[i], rank[j])
    np.minimum.at(low, rank[j], rank[i])
    for x, y in enumerate(low.tolist()):
        a, b = sorted((root(x), root(y)))
        parent[b] = a
    roots = np.array([root(x) for x in range(len(nodes))])
    apart = roots[rank[i]] != roots[rank[j]]
    for x, y in zip(rank[i][apart].tolist(), rank[j][apart].tolist()):
        a, b = sorted((root(x), root(y)))
        parent[b] = a
    ordered = nodes[order]
    return [(int(nodes[k]), int(links[k]), int(ordered[root(int(rank[k]))])) for k in np.flatnonzero(links)]


def _bucket_links(codes: Codes | None, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def found() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            vectors = rows["vec"].combine_chunks()
            units = _units(vectors, len(vectors[0]))
            keys = codes.keys(units) if codes else np.zeros((len(units), 1), dtype=np.uint16)
            sides = (np.asarray(rows["node"]), units, keys, np.asarray(rows["members"]), np.asarray(rows["asking"]))
            table, _, i, j = key
            radius = codes.plan.radius if codes else 0
            if i == j:
                links = linked_in_block(sides, None, table, least, radius)
            else:
                own = np.asarray(rows["slice"]) == i
                links = linked_in_block(tuple(s[own] for s in sides), tuple(s[~own] for s in sides), table, least, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in links], pa.int64()) for c in range(3)], names=["node", "links", "root"])

        for batch in batches:
            names = [batch.column(c) for c in ("table", "key", "i", "j")]
            marks = np.stack([np.asarray(c) for c in names], axis=1)
            starts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                own = tuple(marks[a].tolist())
                if own != key:
                    if sum(h.num_rows for h in held) > 1:
                        yield found()
                    key, held = own, []
                held.append(batch.slice(a, b - a))
        if sum(h.num_rows for h in held) > 1:
            yield found()
    return run


def _coded(classes: DataFrame, codes: Codes) -> DataFrame:
    """classes with ``places``: the tables and keys that each vector stands or asks under, packed in numbers."""
    plan = codes.plan
    bits = np.arange(plan.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vec")
            keys = codes.keys(_units(vectors, codes.projections.shape[0])).astype(np.int64)
            own = (np.arange(plan.tables) << 20 | keys) << 1
            places = own.tolist()
            if plan.radius:
                # Of two keys that differ in one bit the larger one asks under the smaller.
                for at, row in enumerate(keys):
                    tables, bit = np.nonzero(row[:, None] >> bits & 1)
                    places[at] += ((tables << 20 | row[tables] ^ 1 << bit) << 1 | 1).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "places"])

    return classes.select("node", "members", "vec").mapInArrow(
        run, "node long, members long, vec array<double>, places array<long>")


def near_vectors(classes: DataFrame, codes: Codes | None, least: float, block: int = BLOCK) -> DataFrame:
    """(node, links, root) of all pairs of classes (node, vec, members) with a cosine of at least ``least``.

    ``links`` counts members; the rows of a node are to be summed, and the (node, root) are links between nodes.
    Without codes every vector is compared with all of its length.
    """
    if codes is None:
        placed = classes.select("node", "members", "vec", F.lit(0).alias("table"), F.size("vec").cast("long").alias("key"),
                                F.lit(False).alias("asking"))
    else:
        coded = stage(_coded(classes, codes), "vector-codes")
        place = F.col("place")
        placed = coded.select("node", "members", "vec", F.explode("places").alias("place")).select(
            "node", "members", "vec", F.shiftright(place, 21).cast("int").alias("table"),
            F.shiftright(place, 1).bitwiseAND(F.lit((1 << 20) - 1)).alias("key"), (place % 2 == 1).alias("asking"))
    sizes = placed.groupBy("table", "key").agg(F.count("*").alias("rows"))
    large = stage(sizes.filter(F.col("rows") > block), "large-buckets")
    if large.count() <= 10_000:
        rows = placed.join(F.broadcast(large), ["table", "key"], "left")
    else:
        rows = left_lookup(placed, large, ["table", "key"], "rows", HOT_ROWS).withColumn("rows", F.col("found.rows")).drop("found")
    slices = F.ceil(F.coalesce("rows", F.lit(1)) / block).cast("int")
    rows = rows.withColumn("slices", slices).withColumn("slice", F.pmod(F.xxhash64("node"), "slices").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rows = rows.select("table", "key", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"),
                       "slice", "node", "members", "vec", "asking")
    return rows.repartition("table", "key", "i", "j").sortWithinPartitions("table", "key", "i", "j") \
        .mapInArrow(_bucket_links(codes, least), "node long, links long, root long")


def _links_of_all_lengths(classes: DataFrame, least: float, plan: Plan | None, block: int) -> DataFrame:
    """The links of every length's vectors, written."""
    lengths = classes.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows"), F.sum("members").alias("m")) \
        .orderBy(F.desc("m"), "n").limit(CODED_LENGTHS).collect()
    found, coded = [], []
    for length in lengths:
        alike = classes.filter(F.size("vec") == length["n"])
        sample = sampled(alike.select("vec"), "vec", TRAINING_VECTORS).collect()
        units = _units(pa.array([r[0] for r in sample], pa.list_(pa.float64())), length["n"])
        chosen = plan or planned(units, length["rows"], least)
        if chosen is not None:
            coded.append(length["n"])
            found.append(near_vectors(alike, learned(units, chosen), least, block))
    found.append(near_vectors(classes.filter(~F.size("vec").isin(coded)), None, least, block))
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return stage(links, "vector-links")


def near_duplicates(rows: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector: str = "embedding",
                    plan: Plan | None = None, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) for each row; the id is an integer.

    Links join vectors of one length with a cosine of at least ``least`` in double precision; none is made below it.
    Equal vectors are always linked; others if a table finds them, by a ``plan`` or, if not given, as many as RECALL
    needs. Vectors that are null or zero, or hold null or non-finite components, link with nothing. kept marks the
    smallest id of a component. Rows without an id count as links, and are never kept. Repeated rows are vectors of
    their own; an empty table gives an empty result.
    """
    prepared(rows.sparkSession)
    vectors = rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    good = vectors.filter(usable("vec"))
    grouped = good.groupBy("vec").agg(F.min("id").alias("least"), F.count("*").alias("members"))
    classes = stage(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes", rows.count())
    count = classes.count()
    if count:
        links = _links_of_all_lengths(classes, least, plan, block)
        pairs = links.select(F.col("node").alias("a"), F.col("root").alias("b"))
        rooted = stage(with_roots(classes, "node", pairs, count), "vector-roots", count)
        counts = links.groupBy("node").agg(F.sum("links").alias("links"))
        counted = smallest_member(rooted, "least", "component").join(counts, "node", "left").select(
            "vec", "members", "component", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
        counted = stage(counted, "vector-components", count)
    bad = vectors.filter(~usable("vec")).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    if not count:
        found = bad
    else:
        found = left_lookup(good, counted, ["vec"], "members", HOT_ROWS).select(
            "id", F.col("found.links").alias("links"), F.col("found.component").alias("component")).union(bad)
    return found.select(F.col("id").alias(id_col), F.col("links").cast("long").alias("n_links"),
                        F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
