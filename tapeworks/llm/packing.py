"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Texts become pieces of at most a sequence's length. Every round sorts the unplaced pieces and the gaps of the open
sequences by size into ranges. A sweep of each range puts every piece, the largest first, into its successor, the
smallest gap that holds it. Pieces of a range whose gaps are used up all have the same successor, the next gap above;
they are ranked, the first takes it, the second the one behind it, and so on: what ranges leave over is matched by rank
from range to range and swept again. Then the gaps are updated and the round is over.

No more sequences are opened than the pieces need in any case, unless a round places next to nothing. The driver sees
the number of pieces and gaps of each size, and of each range; tables that never grow with the sequences of a range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.bpe import ENCODED_BYTES, encoder_of
from tapeworks.llm.columns import gathered, prepared, regrouped, stage

CAPACITY = 4096
END_ID = 1
# Pieces and gaps of one range, or of one part of what two ranges match; when fewer are left, one sweep ends the work.
RANGE_ROWS = 1 << 16
# A round that places a smaller share of the pieces opens sequences for all that are left.
PROGRESS = 0.02

PIECE, GAP, PLACED = 0, 1, 2
_SWEPT = "kind int, id long, size int, target long, cell long, rank long"


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): each whole text's ids and ``end_id``, cut only where longer than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers. A null text counts as an empty one, whose only piece is the end
    id; repeated rows have pieces of their own; an empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [id_col, "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for part in regrouped(batches, "text", ENCODED_BYTES):
            ends, ids = encoder.encode_flat([t or "" for t in part.column("text").to_pylist()])
            ids = np.insert(ids.astype("<u4"), ends, end_id)
            sizes = np.diff(ends, prepend=0) + 1
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), counts)
            number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            lengths = np.minimum(capacity, sizes[row] - number * capacity)
            bounds = np.append(0, 4 * np.cumsum(lengths)).astype(np.int32)
            cut = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(number * capacity),
                 pa.array(lengths), cut], names=names)

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"`{id_col}` {id_type}, piece int, start long, length long, ids binary")


def best_fit(sizes: Sequence[int], gaps: Sequence[int], capacity: int | None = None) -> tuple[list[int], list[int]]:
    """Where each size goes, in the order given: the smallest gap that holds it; and what is left of the gaps.

    Of equal gaps the last one made is taken. A size that no gap holds goes nowhere (-1), or, with a capacity, into a
    new gap behind the others.
    """
    left, places = list(gaps), []
    by_size: dict[int, list[int]] = {}
    for i, gap in enumerate(left):
        by_size.setdefault(gap, []).append(i)
    there = 0
    for gap in by_size:
        there |= 1 << gap
    for size in sizes:
        larger = there >> size
        if larger:
            gap = size + (larger & -larger).bit_length() - 1
            same = by_size[gap]
            i = same.pop()
            if not same:
                there ^= 1 << gap
        elif capacity is None:
            places.append(-1)
            continue
        else:
            i, gap = len(left), capacity
            left.append(gap)
        places.append(i)
        left[i] = gap = gap - size
        by_size.setdefault(gap, []).append(i)
        there |= 1 << gap
    return places, left


def _sweep_cell(cell: int, kind: np.ndarray, ids: np.ndarray, sizes: np.ndarray, opening: tuple[int, int] | None):
    """The rows (kind, id, size, target, rank) that a sweep of one range leaves.

    Ranked, the largest first, are the pieces without a gap, and the gaps as large as any row of the range, which
    pieces of lower ranges may still take. ``opening`` is the capacity of new sequences and how many there are.
    """
    order = np.lexsort((ids, -sizes))
    kind, ids, sizes = kind[order], ids[order], sizes[order]
    own, gap_ids = kind == PIECE, ids[kind == GAP]
    places, left = best_fit(sizes[own].tolist(), sizes[~own].tolist(), opening and opening[0])
    places, left = np.array(places, dtype=np.int64), np.array(left, dtype=np.int64)
    if opening:
        gap_ids = np.append(gap_ids, -1 - opening[1] - np.arange(len(left) - len(gap_ids)))
    placed = places >= 0
    target = np.where(placed, gap_ids[places] if len(gap_ids) else 0, 0)
    after = np.argsort(-left, kind="stable")
    open_gaps = after[left[after] > 0]
    waiting = np.cumsum(~placed) - 1
    gap_ranks = np.where(left[open_gaps] >= sizes.min(), np.arange(len(open_gaps)), -1)
    return (
        np.concatenate([np.where(placed, PLACED, PIECE), np.full(len(open_gaps), GAP)]),
        np.concatenate([ids[own], gap_ids[open_gaps]]), np.concatenate([sizes[own], left[open_gaps]]),
        np.concatenate([target, np.zeros(len(open_gaps), dtype=np.int64)]),
        np.concatenate([np.where(placed, -1, waiting), gap_ranks]), cell)


def _swept(rows: DataFrame, ranges: int, most: int, opening: tuple[int, int] | None = None) -> DataFrame:
    """A sweep of each range (``cell``) of at most so many pieces and gaps (cell, kind, id, size) in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        cell = None

        def found() -> pa.RecordBatch:
            kind, ids, sizes = np.concatenate(held, axis=1)
            kind, ids, sizes, target, rank, own = _sweep_cell(cell, kind, ids, sizes, opening)
            return pa.RecordBatch.from_arrays(
                [pa.array(kind.astype(np.int32)), pa.array(ids), pa.array(sizes.astype(np.int32)), pa.array(target),
                 pa.array(np.full(len(ids), own, dtype=np.int64)), pa.array(rank)],
                names=["kind", "id", "size", "target", "cell", "rank"])

        for batch in batches:
            cells = np.asarray(batch.column("cell"))
            table = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("kind", "id", "size")])
            bounds = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if held and cells[a] != cell:
                    yield found()
                    held.clear()
                cell = int(cells[a])
                held.append(table[:, a:b])
        if held:
            yield found()

    dealt = rows.repartition(ranges, "cell").sortWithinPartitions("cell")
    return gathered(dealt.select("cell", "kind", "id", "size"), most).mapInArrow(run, _SWEPT)


@dataclass(frozen=True)
class Block:
    """Ranked pieces of one range that meet ranked gaps of a higher one, in ``parts``."""

    first_part: int
    parts: int
    piece_cell: int
    first_piece: int
    n_pieces: int
    gap_cell: int
    first_gap: int
    n_gaps: int


def matched_ranges(left: dict[tuple[int, int], tuple[int, int, int]], rows: int) -> list[Block]:
    """Which pieces of which range meet which gaps, from (number, smallest, largest) of each (range, kind).

    The gaps of each range, from the lowest one up, take the nearest pieces below them that are still there, the
    largest first. As many pieces meet a gap as are sure to go into it.
    """
    waiting: list[list[int]] = []  # range, first piece that is there, number, largest size
    blocks, part = [], 0
    for cell in sorted({cell for cell, _ in left}):
        gaps, smallest, _ = left.get((cell, GAP), (0, 0, 0))
        taken = 0
        while waiting and taken < gaps:
            below, first, there, largest = waiting[-1]
            each = max(1, smallest // largest)
            n = min(there, (gaps - taken) * each)
            used = -(-n // each)
            parts = -(-(n + used) // rows)
            blocks.append(Block(part, parts, below, first, n, cell, taken, used))
            part, taken = part + parts, taken + used
            if n == there:
                waiting.pop()
            else:
                waiting[-1][1:3] = first + n, there - n
        n, _, largest = left.get((cell, PIECE), (0, 0, 0))
        if n:
            waiting.append([cell, 0, n, largest])
    return blocks


def _parted(rows: DataFrame, blocks: list[Block]) -> DataFrame:
    """rows with the part in which they meet others as ``cell``, -1 for those that meet none."""
    sides = {}
    for kind, side in ((PIECE, ("piece_cell", "first_piece", "n_pieces")), (GAP, ("gap_cell", "first_gap", "n_gaps"))):
        table = np.array([[getattr(b, n) for n in (*side, "first_part", "parts")] for b in blocks], dtype=np.int64)
        sides[kind] = table[np.lexsort((table[:, 1], table[:, 0]))]
    shared = rows.sparkSession.sparkContext.broadcast(sides)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, cell, rank = (np.asarray(batch.column(c)) for c in ("kind", "cell", "rank"))
            part = np.full(len(kind), -1, dtype=np.int64)
            for side, table in shared.value.items():
                at = np.flatnonzero((kind == side) & (rank >= 0))
                keys = table[:, 0] * (1 << 40) + table[:, 1]
                of = np.searchsorted(keys, cell[at] * (1 << 40) + rank[at], side="right") - 1
                at, of = at[of >= 0], of[of >= 0]
                cells, first, n, first_part, parts = table[of].T
                behind = rank[at] - first
                inside = (cells == cell[at]) & (behind < n)
                part[at[inside]] = (first_part + behind * parts // n)[inside]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("id"), batch.column("size"), pa.array(part)],
                names=["kind", "id", "size", "cell"])

    return rows.select("kind", "id", "size", "cell", "rank").mapInArrow(run, "kind int, id long, size int, cell long")


def _ranges(counts: dict[int, int], rows: int) -> list[tuple[int, int, int]]:
    """(size, first range, number of ranges) of each size, so that ranges hold about as many rows each."""
    total = sum(counts.values())
    each = -(-total // -(-total // rows))
    found, at = [], 0
    for size in sorted(counts):
        first, last = at // each, (at + counts[size] - 1) // each
        found.append((size, first, last - first + 1))
        at += counts[size]
    return found


def _in_ranges(spark: SparkSession, rows: DataFrame, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """rows with their range as ``cell``; sizes that fill several ranges are dealt over them."""
    by_size = spark.createDataFrame(ranges, "of_size int, first long, ranges long")
    dealt = F.col("first") + F.pmod(F.xxhash64("kind", "id"), F.col("ranges"))
    return rows.join(F.broadcast(by_size), F.col("size") == F.col("of_size")).select("kind", "id", "size", dealt.alias("cell"))


def _needed(pieces: dict[int, int], gaps: dict[int, int], capacity: int) -> int:
    """How many sequences must be opened whatever goes where: for tokens beyond all gaps, and for large pieces."""
    tokens = sum(s * n for s, n in pieces.items()) - sum(s * n for s, n in gaps.items())
    large = sum(n for s, n in pieces.items() if 2 * s > capacity) - sum(n for s, n in gaps.items() if 2 * s > capacity)
    return max(0, -(-tokens // capacity), large)


def assigned(items: DataFrame, capacity: int = CAPACITY, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(id, sequence_id, offset) for items (id, size), whose sizes are from 1 to ``capacity`` and ids at least 0.

    Items as large as a sequence have it for themselves. Sequences have no gaps but behind their last item.
    """
    spark = items.sparkSession
    rows = items.filter(F.col("size") < capacity).select(F.lit(PIECE).alias("kind"), "id", "size")
    results: list[DataFrame] = []
    opened, before = 0, None
    while True:
        counts: dict[int, dict[int, int]] = {PIECE: {}, GAP: {}}
        for kind, size, n in rows.groupBy("kind", "size").agg(F.count("*")).collect():
            counts[kind][size] = n
        waiting = sum(counts[PIECE].values())
        if not waiting:
            break
        least = min(counts[PIECE])
        gaps = {s: n for s, n in counts[GAP].items() if s >= least}
        new = _needed(counts[PIECE], gaps, capacity)
        if not new and before is not None and before - waiting < PROGRESS * before:
            new = _needed(counts[PIECE], {}, capacity)
        before = waiting
        rows = rows.filter((F.col("kind") == PIECE) | (F.col("size") >= least))
        last = waiting + sum(gaps.values()) <= range_rows
        if new and not last:
            added = spark.range(opened, opened + new).select(
                F.lit(GAP).alias("kind"), (-1 - F.col("id")).alias("id"), F.lit(capacity).alias("size"))
            rows, opened = rows.union(added), opened + new
            gaps[capacity] = gaps.get(capacity, 0) + new
        sizes = {s: counts[PIECE].get(s, 0) + gaps.get(s, 0) for s in {*counts[PIECE], *gaps}}
        ranges = [(s, 0, 1) for s in sizes] if last else _ranges(sizes, range_rows)
        n_ranges = max(first + n for _, first, n in ranges)
        total = sum(sizes.values())
        swept = _swept(_in_ranges(spark, rows, ranges), n_ranges, total, (capacity, opened) if last else None)
        swept = stage(swept, "pack-swept")
        results.append(swept)
        if last:
            break
        summary = swept.filter("rank >= 0").groupBy("cell", "kind").agg(F.count("*"), F.min("size"), F.max("size"))
        blocks = matched_ranges({(cell, kind): tuple(rest) for cell, kind, *rest in summary.collect()}, range_rows)
        rest = swept.filter(F.col("kind") != PLACED)
        if blocks:
            parted = _parted(rest, blocks)
            met = _swept(parted.filter("cell >= 0"), blocks[-1].first_part + blocks[-1].parts, total)
            alone = parted.filter("cell < 0").select(
                "kind", "id", "size", F.lit(0).cast("long").alias("target"), "cell", F.lit(-1).cast("long").alias("rank"))
            swept = stage(met.union(alone), "pack-matched", total)
            results.append(swept)
            rest = swept.filter(F.col("kind") != PLACED)
        rows = rest.select("kind", "id", "size")
    whole = items.filter(F.col("size") == capacity).select(
        "id", F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not results:
        return whole
    placed = results[0].filter(F.col("kind") == PLACED)
    for more in results[1:]:
        placed = placed.union(more.filter(F.col("kind") == PLACED))
    earlier = Window.partitionBy("target").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(earlier), F.lit(0)).cast("long")
    return whole.union(placed.select("id", F.col("target").alias("sequence_id"), offset.alias("offset")))


def packed(rows: DataFrame, size: str = "length", capacity: int = CAPACITY, range_rows: int = RANGE_ROWS) -> DataFrame:
    """rows with the sequence they go into and the place there: ``sequence_id`` and ``offset``.

    As few sequences as best-fit finds, without gaps before their ends. Rows whose size is null, below 1 or above the
    capacity go into none and have nulls. Repeated rows are rows of their own, columns that have the names of the new
    ones are replaced, an empty table gives an empty result. It comes in no more partitions than its rows need.
    """
    kept = [c for c in rows.columns if c.lower() not in ("sequence_id", "offset")]
    numbered = stage(rows.select(*(F.col(f"`{c}`") for c in kept), F.monotonically_increasing_id().alias("__item")), "pack-items")
    items = numbered.filter(F.col(f"`{size}`").between(1, capacity)).select(
        F.col("__item").alias("id"), F.col(f"`{size}`").cast("int").alias("size"))
    found = assigned(items, capacity, range_rows).withColumnRenamed("id", "__found")
    joined = numbered.join(found, F.col("__item") == F.col("__found"), "left")
    return gathered(joined.select(*(F.col(f"`{c}`") for c in kept), "sequence_id", "offset"), numbered.count())
