"""An index of the keys that a table holds, for looking up a batch without reading the whole of it.

Every addition is a run of its own. A run is cut by the leading bits of a hash of the key into as many parts as keep
each near KEYS_PER_PART keys, so the number of parts grows with the keys. Beside each part stands a Bloom filter in
pages of one bitmap: all bits of a key lie in one page. A batch reads the filters of the parts that its keys would be
in, and then only the parts whose filter says that one of them may be there.

Runs of like size are merged, MERGED_RUNS of them at a time; a key is written again once for each such step, and the
number of runs grows with the logarithm of the keys.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.session import workspace
from tapeworks.sinks.files import delete, read_note, staged, write_note

KEYS_PER_PART = 1 << 20
MERGED_RUNS = 8
BITS_PER_KEY = 16
# Bits of a key in its page, each 15 bits of a hash wide; a page is one of the engine's bitmaps.
PROBES = 4
PAGE_BITS = 1 << 15
# Keys of a batch that may be in the index are broadcast up to this number.
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class Run:
    """One sorted addition: its number, parts (a power of two), pages of each part's filter, and keys."""

    number: int
    parts: int
    pages: int
    keys: int

    def part(self, hashed: Column) -> Column:
        """The part of a key, from the leading bits of its hash."""
        bits = self.parts.bit_length() - 1
        return (F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0)).cast("int")


def _page(key: str) -> Column:
    return F.xxhash64(F.lit(1), key)


def _bits(key: str) -> Column:
    hashed = F.xxhash64(F.lit(2), key)
    return F.array(*(F.shiftrightunsigned(hashed, 15 * i).bitwiseAND(F.lit(PAGE_BITS - 1)) for i in range(PROBES)))


def _is_set(page: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(page), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


class KeyIndex:
    """The index below a folder; rows are (key, content). One job at a time may change it."""

    def __init__(self, spark: SparkSession, home: str, key: str, keys_per_part: int = KEYS_PER_PART) -> None:
        self.spark, self.home, self.key, self.keys_per_part = spark, home, key, keys_per_part

    # What there is stands in one note; a run that it does not name is left from a failure.

    def _state(self) -> dict | None:
        note = read_note(self.spark, f"{self.home}/state")
        return json.loads(note) if note else None

    def _store(self, runs: Sequence[Run], of: str, next_run: int, pending: bool = False) -> None:
        state = {"runs": [asdict(r) for r in runs], "of": of, "next_run": next_run, "pending": pending}
        write_note(self.spark, f"{self.home}/state", json.dumps(state))

    def runs(self) -> list[Run]:
        return [Run(**r) for r in (self._state() or {"runs": []})["runs"]]

    def is_of(self, table: str) -> bool:
        """Whether the index holds the keys of that content of the table, and of nothing else."""
        state = self._state()
        return state is not None and state["of"] == table and not state["pending"]

    def begin(self) -> None:
        """Marks that the table is about to grow: until :meth:`add` has ended, the index is not that of the table."""
        state = self._state()
        self._store(self.runs(), state["of"], state["next_run"], pending=True)

    def build(self, rows: DataFrame, of: str) -> None:
        """Makes the index anew from all rows of a table."""
        old, state = self.runs(), self._state()
        run = self._write(rows, state["next_run"] if state else 1, rows.count())
        self._store([run] if run else [], of, (state["next_run"] if state else 1) + 1)
        for r in old:
            self._drop(r)

    def add(self, rows: DataFrame, n: int) -> None:
        """Adds the ``n`` rows, whose keys the index does not hold yet, and merges runs of like size."""
        state, runs = self._state(), self.runs()
        number = state["next_run"]
        run = self._write(rows, number, n)
        runs, number, merged = [*runs, *([run] if run else [])], number + 1, []
        while like := self._of_like_size(runs):
            both = self._read(like[0], None)
            for r in like[1:]:
                both = both.unionByName(self._read(r, None))
            whole = self._write(both.select(self.key, "content"), number, sum(r.keys for r in like))
            runs, merged, number = [*(r for r in runs if r not in like), whole], [*merged, *like], number + 1
        self._store(runs, state["of"], number)
        for r in merged:
            self._drop(r)

    @staticmethod
    def _of_like_size(runs: Sequence[Run]) -> list[Run]:
        tiers: dict[int, list[Run]] = {}
        for r in runs:
            size = tier = 0
            while MERGED_RUNS ** (size + 1) <= r.keys:
                size += 1
                tier = size
            tiers.setdefault(tier, []).append(r)
        return next((held for held in tiers.values() if len(held) >= MERGED_RUNS), [])

    def _write(self, rows: DataFrame, number: int, n: int) -> Run | None:
        if not n:
            return None
        parts = 1
        while parts * self.keys_per_part < n:
            parts *= 2
        run = Run(number, parts, max(1, -(-n * BITS_PER_KEY // (parts * PAGE_BITS))), n)
        hashed = F.xxhash64(self.key)
        cut = rows.select(self.key, "content", hashed.alias("hash"), run.part(hashed).alias("part"))
        self._dealt(cut, parts).sortWithinPartitions("part", "hash").write.mode("overwrite") \
            .partitionBy("part").parquet(f"{self.home}/keys/run={number}")
        written = self.spark.read.parquet(f"{self.home}/keys/run={number}")
        bits = written.select("part", F.pmod(_page(self.key), F.lit(run.pages)).alias("page"), F.explode(_bits(self.key)).alias("bit"))
        pages = bits.groupBy("part", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self._dealt(pages, parts).write.mode("overwrite").partitionBy("part").parquet(f"{self.home}/filters/run={number}")
        return run

    @staticmethod
    def _dealt(rows: DataFrame, parts: int) -> DataFrame:
        """Every part in a task of its own: by a hash of its number, one task would get several and others none."""
        tasks = min(parts, 1 << 16)
        return rows.repartitionById(tasks, F.col("part") % tasks)

    def _read(self, run: Run, parts: Sequence[int] | None, kind: str = "keys") -> DataFrame:
        """Some parts of a run, all if none are named, with the run's number; folders of other parts are not listed."""
        folder = f"{self.home}/{kind}/run={run.number}"
        paths = [folder] if parts is None or 2 * len(parts) > run.parts else [f"{folder}/part={p}" for p in parts]
        rows = self.spark.read.option("basePath", folder).parquet(*paths).withColumn("run", F.lit(run.number))
        return rows if parts is None else rows.filter(F.col("part").isin(*parts))

    def _drop(self, run: Run) -> None:
        for kind in ("keys", "filters"):
            delete(self.spark, f"{self.home}/{kind}/run={run.number}")

    def _in_parts(self, found: DataFrame) -> dict[int, list[int]]:
        """The (run, part) that rows name, by run; no more than there are files."""
        parts: dict[int, list[int]] = {}
        for run, part in found.select("run", "part").distinct().collect():
            parts.setdefault(run, []).append(part)
        return parts

    def candidates(self, batch: DataFrame) -> DataFrame:
        """(key, run, part) for the keys of the batch that a part may hold, by its filter."""
        runs = self.runs()
        hashed = F.xxhash64(self.key)
        places = [F.struct(F.lit(r.number).alias("run"), r.part(hashed).alias("part"),
                           F.pmod(_page(self.key), F.lit(r.pages)).alias("page")) for r in runs]
        asked = batch.select(self.key, F.inline(F.array(*places)))
        filters = None
        by_number = {r.number: r for r in runs}
        for number, parts in self._in_parts(asked).items():
            pages = self._read(by_number[number], parts, "filters").select("run", "part", "page", "bits")
            filters = pages if filters is None else filters.unionByName(pages)
        if filters is None:
            return asked.select(self.key, "run", "part").limit(0)
        # The pages are sent to the keys that ask for them; a page is 4 KB, and stands on one row.
        met = asked.join(filters.hint("shuffle_hash"), ["run", "part", "page"]).withColumn("wanted", _bits(self.key))
        return met.filter(F.forall("wanted", lambda bit: _is_set("bits", bit))).select(self.key, "run", "part")

    def known(self, batch: DataFrame) -> DataFrame:
        """(key, content) of the keys of the batch, distinct ones, that the index holds.

        Only parts that may hold one are read; there, the batch's keys are hashed and the index streams past them.
        """
        runs = self.runs()
        if not runs:
            return batch.select(self.key, F.lit(None).cast("long").alias("content")).limit(0)
        if sum(r.keys for r in runs) <= self.keys_per_part:  # not worth two looks
            held = self._read(runs[0], None)
            for r in runs[1:]:
                held = held.unionByName(self._read(r, None))
            return held.select(self.key, "content").join(batch.select(self.key).hint("shuffle_hash"), self.key)
        found = staged(self.candidates(batch), workspace(self.spark, "key-candidates"))
        rows = None
        by_number = {r.number: r for r in runs}
        for number, parts in self._in_parts(found).items():
            held = self._read(by_number[number], parts).select(self.key, "content", "run", "part")
            rows = held if rows is None else rows.unionByName(held)
        if rows is None:
            return batch.select(self.key, F.lit(None).cast("long").alias("content")).limit(0)
        few = found.count() <= BROADCAST_KEYS
        return rows.join(found.hint("broadcast" if few else "shuffle_hash"), [self.key, "run", "part"]).select(self.key, "content")
