"""Document fingerprints from closed syncmers.

A run of K bytes is a closed syncmer if the smallest hash of its runs of S bytes is that of the first or the last one.
Whether it is depends on its own bytes alone, so the same passage has the same anchors in every document, at the same
distances. A fingerprint is all anchors of a text, in order and with their distances, so that passages common to two
texts are found from their fingerprints; the likeness of two is the share of their anchors that match in order.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.columns import SLICE_BYTES, Compute, add_columns, byte_sizes, slices

K, S = 12, 4
_PIECE = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _anchors_of_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    padded = data + b"\0" * S
    runs = np.empty(len(data) - S + 1, dtype=np.uint64)
    for offset in range(S):
        part = runs[offset::S]
        part[:] = np.frombuffer(padded, dtype=f"<u{S}", count=len(part), offset=offset)
    hashes = _mixed(runs)
    least, width = hashes, 1
    while width * 2 <= K - S + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = K - S + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = np.flatnonzero((least == hashes[: len(least)]) | (least == hashes[K - S :]))
    whole = hashes[at]
    for step in range(S, K - S + 1, S):
        whole = _mixed(whole * np.uint64(3) + hashes[at + step])
    return at, whole


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions and 64-bit hashes of the text's closed syncmers, in order.

    A text that has none, as one shorter than K bytes, is one anchor as a whole; an empty one has none. Long texts are
    gone through in pieces that overlap by K - 1 bytes, so none is cut short and no anchor lost.
    """
    at, hashes = _syncmers(data)
    if len(at) or not data:
        return at, hashes
    return np.zeros(1, dtype=np.int64), np.frombuffer(hashlib.blake2b(data, digest_size=8).digest(), dtype="<u8")


def _syncmers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(data) < K:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if len(data) <= _PIECE:
        return _anchors_of_piece(data)
    parts = [(a, *_anchors_of_piece(data[a : a + _PIECE + K - 1])) for a in range(0, len(data) - K + 1, _PIECE)]
    return np.concatenate([at + a for a, at, _ in parts]), np.concatenate([h for _, _, h in parts])


# Bits of a hash in a fingerprint; with the distance, at most K - S, an anchor takes three bytes.
HASH_BITS = 20


@dataclass(frozen=True)
class Sketch:
    """All anchors of a text, in order: their byte positions and the upper bits of their hashes.

    ``rim`` is a hash of what lies before the first and behind the last anchor, and of these two; with it, texts that
    differ in a byte anywhere have different sketches.
    """

    at: np.ndarray
    hashes: np.ndarray
    rim: int

    def __len__(self) -> int:
        return len(self.at)

    @cached_property
    def codes(self) -> np.ndarray:
        """Each anchor's distance from the one before (from the text's beginning, if it is the first) and its hash."""
        return np.diff(self.at, prepend=0).astype(np.uint32) << np.uint32(HASH_BITS) | self.hashes


def sketch(text: str | None) -> Sketch:
    """Every anchor of the text."""
    data = (text or "").encode()
    at, hashes = anchors(data)
    rim = 0
    if len(at):
        ends = data[: at[0]], data[at[-1] + K :], hashes[[0, -1]].tobytes()
        rim = int.from_bytes(hashlib.blake2b(b"".join(len(e).to_bytes(4, "big") + e for e in ends), digest_size=3).digest())
    return Sketch(at, (hashes >> np.uint64(64 - HASH_BITS)).astype(np.uint32), rim)


def shown(of: Sketch) -> str:
    """A fingerprint in base 64, four characters for the rim and four for each anchor's code; empty for an empty text.

    An anchor stands for about four and a half bytes of prose, so a fingerprint is shorter than its text.
    """
    if not len(of):
        return ""
    numbers = np.append(np.uint32(of.rim), of.codes).astype(">u4")
    return base64.b64encode(numbers.view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()).decode()


def read(fingerprint: str) -> Sketch:
    """The anchors that a fingerprint shows."""
    held = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 3).astype(np.uint32)
    numbers = held[:, 0] << 16 | held[:, 1] << 8 | held[:, 2]
    codes = numbers[1:]
    return Sketch(np.cumsum((codes >> HASH_BITS).astype(np.int64)), codes & np.uint32((1 << HASH_BITS) - 1),
                  int(numbers[0]) if len(numbers) else 0)


def _equal_at_first(a: np.ndarray, b: np.ndarray) -> int:
    """How many values are equal before the first that differ; looked at in ever longer stretches."""
    n, at, width = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + width)
        differing = np.flatnonzero(a[at:end] != b[at:end])
        if len(differing):
            return at + int(differing[0])
        at, width = end, 2 * width
    return n


def _increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing run of values, not side by side."""
    ends: list[int] = []
    places: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        at = bisect_left(ends, value)
        if at == len(ends):
            ends.append(value)
            places.append(i)
        else:
            ends[at], places[at] = value, i
        before[i] = places[at - 1] if at else -1
    found = []
    i = places[-1] if places else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def _matched_between(a: np.ndarray, b: np.ndarray) -> int:
    """How many anchors match in order, by runs at one distance between the texts.

    Anchors that stand once on each side and match beside another one say where runs are; of these the longest
    sequence that is in order on both sides is taken, and its runs go on as far as the anchors match.
    """
    if not len(a) or not len(b):
        return 0
    mask = np.uint32((1 << HASH_BITS) - 1)
    sides = []
    for codes in (a, b):
        value, first, times = np.unique(codes & mask, return_index=True, return_counts=True)
        sides.append((value[times == 1], first[times == 1]))
    _, x, y = np.intersect1d(sides[0][0], sides[1][0], assume_unique=True, return_indices=True)
    i, j = sides[0][1][x], sides[1][1][y]
    ahead = (i + 1 < len(a)) & (j + 1 < len(b))
    ahead[ahead] = a[i[ahead] + 1] == b[j[ahead] + 1]
    behind = (i > 0) & (j > 0) & (a[i] == b[j])
    behind[behind] = (a[i[behind] - 1] & mask) == (b[j[behind] - 1] & mask)
    order = np.argsort(i[ahead | behind])
    i, j = i[ahead | behind][order].tolist(), j[ahead | behind][order].tolist()
    hashes_a, hashes_b = a & mask, b & mask
    total, last_i, last_j = 0, -1, -1
    for k in _increasing(j):
        if i[k] <= last_i or j[k] <= last_j:
            continue
        room = min(i[k] - last_i, j[k] - last_j)  # anchors up to this one that may match, itself included
        same = _equal_at_first(a[i[k] - room + 1 : i[k] + 1][::-1], b[j[k] - room + 1 : j[k] + 1][::-1])
        # A code holds the distance to the anchor before, which may match without being as far from its own.
        back = max(0, same - 1) + int(0 < same < room and hashes_a[i[k] - same] == hashes_b[j[k] - same])
        on = _equal_at_first(a[i[k] + 1 :], b[j[k] + 1 :])
        total += back + 1 + on
        last_i, last_j = i[k] + on, j[k] + on
    return total


def likeness(a: Sketch, b: Sketch) -> float:
    """Twice the anchors that match in order, and the rim, over those of both texts; 1 for equal texts only.

    Anchors match in order if the runs that they make up, each at one distance between the texts, follow each other in
    both. Two empty texts are alike, an empty and another one are not.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    first = _equal_at_first(a.codes, b.codes)
    rest = a.codes[first:], b.codes[first:]
    last = _equal_at_first(rest[0][::-1], rest[1][::-1])
    between = _matched_between(rest[0][: len(rest[0]) - last], rest[1][: len(rest[1]) - last])
    return 2 * (first + last + between + (a.rim == b.rim)) / (len(a) + len(b) + 2)


def matched_anchors(left: Sketch, right: Sketch) -> list[tuple[int, int, int]]:
    """Passages common to two texts, by position: (byte in left, byte in right, length), in order.

    Anchors with the same hash are paired; pairs at one distance between the texts that overlap or touch make up
    one passage. Hashes that stand more than once in a text say nothing about positions and are left out.
    """
    places = []
    for side in (left, right):
        value, first, count = np.unique(side.hashes, return_index=True, return_counts=True)
        places.append(dict(zip(value[count == 1].tolist(), side.at[first[count == 1]].tolist())))
    pairs = sorted((places[1][h] - a, a) for h, a in places[0].items() if h in places[1])
    runs: list[list[int]] = []
    for shift, a in pairs:
        if runs and runs[-1][0] == shift and a <= runs[-1][2]:
            runs[-1][2] = a + K
        else:
            runs.append([shift, a, a + K])
    return sorted((a, a + shift, end - a) for shift, a, end in runs)


def matched(left: str, right: str) -> list[tuple[int, int, int]]:
    """``matched_anchors`` of two texts."""
    return matched_anchors(sketch(left), sketch(right))


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """docs with each whole text's fingerprint; null like empty, equal texts alike, repeated rows stay.

    A column that has the name of the fingerprint is replaced.
    """
    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([shown(sketch(t)) for t in batch.column(text).to_pylist()], pa.string())]
        return compute

    return add_columns(docs, text, T.StructType([T.StructField(name, T.StringType())]), make, keep)


def _bucket(key: Column, splits: Sequence[int]) -> Column:
    """How many of the ascending splits are not above the key, by bisection."""
    held = F.array(*(F.lit(s).cast("long") for s in splits))
    steps = [1 << i for i in range(len(splits).bit_length() - 1, -1, -1)] if splits else []
    found = F.lit(0)
    if steps:
        found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
            (at + step <= len(splits)) & (F.get(held, at + step - 1) <= key), at + step).otherwise(at))
    return F.coalesce(found, F.lit(0))


def in_order(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, text, bucket, ahead): documents in ranges by id, one range for each task and in order there.

    Behind each range stands, marked as ahead, the document that follows it: the first of the next range, which is
    known because ranges begin at ids that are in the table; after the last range the first document of all. So
    every task sees each of its documents with the next one. Rows without id come first; rows with equal ids are
    ordered by their texts.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = [i / tasks for i in range(1, tasks)]
    points, least, missing = docs.agg(
        F.percentile_approx(id_col, share or [0.5], max(10_000, 20 * tasks)), F.min(id_col),
        F.count(F.when(F.col(id_col).isNull(), 1))).first()
    splits = sorted({p for p in points or [] if p is not None and p != least or missing}) if share else []
    key, bucket = F.col(id_col), F.col("bucket")
    rows = docs.select(key.alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       _bucket(key, splits).alias("bucket"))
    starts = F.lit(False)
    if splits:
        starts = F.coalesce(F.get(F.array(*(F.lit(s).cast("long") for s in splits)), bucket - 1) == F.col("id"), F.lit(False))
    first = F.col("id").isNull() if missing else F.coalesce(F.col("id") == F.lit(least), F.lit(False))
    place = F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("ahead")))
    place = F.concat(place, F.when(starts, F.array(F.struct((bucket - 1).alias("bucket"), F.lit(True).alias("ahead"))))
                     .otherwise(F.filter(place, lambda _: F.lit(False))))
    place = F.concat(place, F.when(first, F.array(F.struct(F.lit(len(splits)).alias("bucket"), F.lit(True).alias("ahead"))))
                     .otherwise(F.filter(place, lambda _: F.lit(False))))
    placed = rows.select("id", "text", F.explode(place).alias("p")).select("id", "text", "p.bucket", "p.ahead")
    return placed.repartitionById(len(splits) + 1, F.col("bucket")).sortWithinPartitions(
        "bucket", "ahead", F.col("id").asc_nulls_first(), F.xxhash64("text"))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The id is an integer or null; see ``in_order`` for what comes next. A null text counts as an empty one, a single
    document is its own next one, an empty table gives an empty result.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next"))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part in slices(batch, byte_sizes(batch.column("text"))):
                yield from zip(*(part.column(c).to_pylist() for c in ("id", "text", "ahead")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, out, size, held = to_arrow_schema(schema), [], 0, None
        for key, value, ahead in rows(batches):
            own = sketch(value)
            if held is not None:
                before, before_text, before_sketch = held
                changed = edited(before_text, value)
                other = sketch(changed)
                out.append((before, len(before_text), hashlib.sha256(changed.encode()).hexdigest(), shown(before_sketch),
                            shown(other), likeness(before_sketch, other), likeness(before_sketch, own)))
                size += 4 * (len(before_sketch) + len(other))
            held = None if ahead else (key, value, own)
            if len(out) == 1000 or size > SLICE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return in_order(docs, id_col, text).mapInArrow(run, schema)
