"""SimHash near-dedup: fingerprints that differ in few bits are found with BK-trees over shards.

Fingerprints within r bits of each other agree on at least one of r + 1 blocks of bits. So each goes to the r + 1
shards of its blocks' values, where a BK-tree answers: children hang by their Hamming distance to the parent, and
a search follows only the edges whose distance is within the radius of its own. A shard with too many members is
cut by the blocks of its remaining bits in the same way, which loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.skew import left_lookup
from tapeworks.llm.columns import Compute, add_columns, stage, without
from tapeworks.llm.components import HOT_ROWS, smallest_member, with_roots

BITS = 64
SEED = 42
# Members of a shard beyond which it is cut further.
SHARD_MEMBERS = 512
_PIECE = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit number; 0 without words."""
    import xxhash

    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens)] if len(tokens) < words else map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, _PIECE):
        piece = hashes[i : i + _PIECE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", name: str = "fp",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """docs with the SimHash of each whole text; A-Z count as lower case, null like an empty text."""
    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([fingerprint(t, words) for t in batch.column(text).to_pylist()], pa.int64())]
        return compute

    return add_columns(docs, text, T.StructType([T.StructField(name, T.LongType())]), make, keep)


class Tree:
    """A BK-tree of integers under Hamming distance."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            held, children = open_nodes.pop()
            distance = (held ^ value).bit_count()
            if distance <= radius:
                found.append(held)
            for d in range(max(1, distance - radius), distance + radius + 1):
                if d in children:
                    open_nodes.append(children[d])
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        held, children = self.root
        while distance := (held ^ value).bit_count():
            if distance not in children:
                children[distance] = (value, {})
                return
            held, children = children[distance]


def linked_to_least(values: Sequence[int], radius: int) -> list[tuple[int, int]]:
    """(value, root) for each value that a chain of links within the radius joins to a smaller one, its root."""
    tree, parent = Tree(), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for value in values:
        parent[value] = value
        for near in tree.within(value & (2**64 - 1), radius):
            a, b = sorted((root(value), root(near - 2**64 if near >> 63 else near)))
            parent[b] = a
        tree.add(value & (2**64 - 1))
    return [(v, r) for v in values if (r := root(v)) != v]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks(mask: int, radius: int) -> list[int]:
    """The mask with each of the radius + 1 blocks that make up the bits it lacks."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    parts = np.array_split(np.array(free), radius + 1)
    return [mask | sum(1 << int(i) for i in part) for part in parts]


def _shard_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        key = None

        def links(found: list[int]) -> pa.RecordBatch:
            pairs = linked_to_least(found, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for mask, value, fp in zip(*(batch.column(c).to_pylist() for c in ("mask", "value", "fp"))):
                if (mask, value) != key:
                    if len(held) > 1:
                        yield links(held)
                    key, held = (mask, value), []
                held.append(fp)
        if len(held) > 1:
            yield links(held)
    return run


def near_links(values: DataFrame, radius: int = 3, members: int = SHARD_MEMBERS) -> DataFrame:
    """Links (a, b) that join every two of the different numbers ``fp`` within the radius, directly or by a chain.

    Each shard gives at most one link for each member, not all its pairs.
    """
    masks = blocks(0, radius)
    rows = values.withColumn("mask", F.explode(F.array(*(F.lit(_signed(m)).cast("long") for m in masks))))
    rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    small: DataFrame | None = None
    count = values.count() * len(masks)
    while True:
        rows = stage(rows, "shards", count)
        counts = rows.groupBy("mask", "value").agg(F.count("*").alias("members"))
        many = stage(counts.filter(F.col("members") > members), "large-shards", count // members)
        # Only a few bits are free in the end: such a shard has no more members than they have values.
        free = min(BITS - m.bit_count() for m in masks)
        held = many.agg(F.sum("members")).first()[0] or 0
        last = free < 4 * (radius + 1) or not held
        part = rows if last else rows.join(many.select("mask", "value"), ["mask", "value"], "left_anti")
        part = part.select("mask", "value", "fp")
        small = part if small is None else small.union(part)
        if last:
            break
        finer = F.create_map(*(x for m in masks for x in (F.lit(_signed(m)).cast("long"), F.array(
            *(F.lit(_signed(b)).cast("long") for b in blocks(m, radius))))))
        large = left_lookup(rows, many, ["mask", "value"], "members", HOT_ROWS).filter("found is not null")
        rows, count = large.select("fp", F.explode(finer[F.col("mask")]).alias("mask")), held * (radius + 1)
        rows = rows.distinct().withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        masks = sorted({b for m in masks for b in blocks(m, radius)})
    return small.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp") \
        .mapInArrow(_shard_links(radius), "a long, b long")


def hex_of(fp: str):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def _classes(prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """One row per fingerprint: fp, docs, least (smallest id), root, component_id."""
    grouped = prints.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("docs"))
    classes = stage(grouped, "classes", prints.count())
    count = classes.count()
    rooted = with_roots(classes, "fp", near_links(classes.select("fp"), radius), count)
    return smallest_member(stage(rooted, "rooted", count), "least", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for each row of docs; the id is an integer.

    Texts whose fingerprints differ in at most ``radius`` bits are linked, and component_id is the smallest id
    that links reach. Null and empty texts have fingerprint zero and link like any other. Rows without an id
    count in their component; its id is null if no member has one. Repeated rows stay.
    """
    prints = stage(fingerprints(docs, words, text, "fp", [id_col]), "fingerprints")
    found = left_lookup(prints, _classes(prints, id_col, radius).select("fp", "docs", "component_id"), ["fp"], "docs",
                        HOT_ROWS)
    return found.select(id_col, hex_of("fp").alias("fingerprint"), F.col("found.component_id").alias("component_id"))


def deduplicated(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, with the columns of docs.

    A row with an id goes before rows without; of rows with the same id that with the smaller fingerprint and text
    hash stays.
    """
    columns = without(docs, ["__fp"])
    taken, digest = docs.select(*[f"`{c}`" for c in columns]), F.xxhash64(text)
    # Only ids, fingerprints and hashes are sorted and grouped; the texts are met once, at the end, and never sorted.
    narrow = taken.select(F.col(id_col).alias("id"), F.col(text).alias("text"), digest.alias("digest"))
    prints = stage(fingerprints(narrow, words, "text", "fp", ["id", "digest"]), "fingerprints")
    classes = stage(_classes(prints.select("id", "fp"), "id", radius), "components")
    # The fingerprint of the kept row: among those that hold the smallest id of a component, the smallest one.
    best = classes.groupBy("root").agg(F.min(F.struct(
        F.col("least").isNull(), "least", "fp")).alias("best")).select("best.least", F.col("best.fp").alias("fp"))
    copies = prints.groupBy("id", "fp", "digest").agg(F.count("*").alias("copies")).alias("c")
    chosen = copies.join(best.alias("b"), (F.col("c.fp") == F.col("b.fp")) & F.col("c.id").eqNullSafe(F.col("b.least")))
    kept = chosen.groupBy("c.id", "c.fp").agg(F.min(F.struct("digest", "copies")).alias("first")).select(
        F.col("id").alias("__id"), F.col("first.digest").alias("__kept"), F.col("first.copies").alias("__copies"))
    kept = stage(kept, "kept")
    here = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    found = taken.withColumn("__digest", digest).join(kept.hint("shuffle_hash"), here)
    own = [f"`{c}`" for c in columns]
    if kept.filter("__copies > 1").isEmpty():
        return found.select(*own)
    nth = F.row_number().over(Window.partitionBy("__id", "__kept").orderBy("__copies"))
    again = found.filter("__copies > 1").withColumn("__nth", nth).filter("__nth = 1")
    return found.filter("__copies = 1").select(*own).unionByName(again.select(*own))
