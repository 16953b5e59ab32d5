"""Periodic run detection by string synchronising sets.

A run is a stretch of words with a smallest period that no neighbouring word extends. For every scale t = 8, 16, 32 ...
a synchronising set holds the positions whose window of t words has the least hash among the windows that begin in the
t words behind it, or in the t words before its end: whether a position belongs to it depends on the 2t words from
there on alone (its context), so a run of period q in [3t, 6t) has two such positions q apart, with equal contexts.
Equal contexts at such a distance propose a period, and the words around them decide.

Windows with a period of at most t/3 would make these sets dense, and are left out of them. They lie in runs that are
known by then: periods below 24 come from comparing the words with the same words some places on, larger ones from the
smaller scales. A run whose period is such a region as a whole, and which no position of the set therefore meets, joins
two regions of one period that overlap by less than it; the places where such regions meet give those runs.

Contexts are compared by their hashes, and every run word by word before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tapeworks.llm.columns import Compute, add_columns, byte_sizes, slices

# A run has this many words at least, and two periods.
LEAST_WORDS = 12
FIRST_SCALE = 8
# Texts are worked on together, about so many bytes at a time; the arrays of a group then fit a processor's cache.
GROUP_BYTES = 1 << 20
# Words that are compared at once where many proposals are extended.
COMPARED = 1 << 22

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
FIELDS = T.StructType([T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])

Runs = np.ndarray  # rows of (start, end, period)
_NO_RUNS = np.zeros((0, 3), dtype=np.int64)
_NEVER = np.uint64(2**64 - 1)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of neighbours as one."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of True begin, and where they have ended."""
    at = np.flatnonzero(equal)
    if not len(at):
        return at, at
    breaks = np.flatnonzero(np.diff(at) > 1)
    return at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)] + 1


def _extent(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words on from each position, in steps of 1 or -1, equal the word a period later."""
    found = np.zeros(len(at), dtype=np.int64)
    going, last = np.arange(len(at)), len(words) - 1
    width = 16
    while len(going):
        left = []
        for part in np.array_split(going, -(-len(going) * width // COMPARED)):
            place = (at[part] + step * found[part])[:, None] + step * np.arange(width)
            place = place.clip(0, last)
            same = words[place] == words[np.minimum(place + period[part, None], last)]
            ended = ~same.all(axis=1)
            found[part] += np.where(ended, same.argmin(axis=1), width)
            left.append(part[~ended])
        going = np.concatenate(left)
        width = min(2 * width, 1 << 16)
    return found


def _smallest(runs: Runs) -> Runs:
    """Of runs over the same words only the one with the smallest period; sorted by their ends."""
    order = np.lexsort((runs[:, 2], runs[:, 0], runs[:, 1]))
    runs = runs[order]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _short_periods(words: np.ndarray, most: int) -> Runs:
    """Runs of all periods up to ``most``; of periods 1 and 2 also some that are only regions."""
    found = [_NO_RUNS]
    for period in range(1, min(most, len(words) - 1) + 1):
        starts, ends = _stretches(words[:-period] == words[period:])
        least = max(2 * period, LEAST_WORDS if period > FIRST_SCALE // 3 else FIRST_SCALE)
        long = ends + period - starts >= least
        found.append(np.stack([starts[long], ends[long] + period, np.full(long.sum(), period)], axis=1))
    return np.concatenate(found)


def _synchronising(hashes: np.ndarray, scale: int, regions: Runs) -> np.ndarray:
    """The positions of the set, from the hashes of all windows of ``scale`` words."""
    ids = hashes.copy()
    if len(regions):
        inside = np.zeros(len(ids) + 1, dtype=np.int32)
        starts, ends = regions[:, 0], np.minimum(regions[:, 1] - scale + 1, len(ids))
        some = starts < ends
        np.add.at(inside, starts[some], 1)
        np.add.at(inside, ends[some], -1)
        ids[np.cumsum(inside[:-1]) > 0] = _NEVER
    least, width = ids, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], ids[scale:])
    return np.flatnonzero(((least == ids[:-scale]) | (least == ids[scale:])) & (least != _NEVER))


def _proposals(at: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of all pairs of equal contexts that are 3 to 6 scales apart.

    A context of the set has no period of a third of the scale, so it begins at most 18 times within 6 scales.
    """
    order = np.argsort(contexts, kind="stable")
    at, contexts = at[order], contexts[order]
    again = np.zeros(len(at) + 1, dtype=bool)
    again[1:-1] = contexts[1:] == contexts[:-1]
    again = again[1:] | again[:-1]
    at, contexts = at[again], contexts[again]
    positions, periods = [], []
    for lag in count(1):
        apart = at[lag:] - at[:-lag]
        near = (contexts[lag:] == contexts[:-lag]) & (apart < 6 * scale)
        if not near.any():
            break
        near &= apart >= 3 * scale
        positions.append(at[:-lag][near])
        periods.append(apart[near])
    return tuple(np.concatenate([np.zeros(0, dtype=np.int64), *side]) for side in (positions, periods))


def _verified(words: np.ndarray, runs: Runs) -> Runs:
    """The runs compared word by word; one that two equal hashes of different contexts made too long is cut."""
    sound = []
    for start, end, period in runs.tolist():
        equal = words[start : end - period] == words[start + period : end]
        if equal.all():
            sound.append((start, end, period))
        else:
            sound += [(start + a, start + b + period, period) for a, b in zip(*_stretches(equal)) if b - a >= period]
    return np.array(sound, dtype=np.int64).reshape(-1, 3)


def _proposed_runs(words: np.ndarray, at: np.ndarray, period: np.ndarray, scale: int) -> Runs:
    """The runs of the proposals. Those of one period whose contexts touch are extended together."""
    if not len(at):
        return _NO_RUNS
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.append(True, (np.diff(period) != 0) | (np.diff(at) > 2 * scale))
    first, period = at[new], period[new]
    after = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] + 2 * scale
    starts = first - _extent(words, first - 1, period, -1)
    ends = after + _extent(words, after, period, 1) + period
    runs = np.stack([starts, ends, period], axis=1)
    runs = np.unique(runs[ends - starts >= 2 * period], axis=0)
    return _verified(words, runs)


def _phase(words: np.ndarray, end: int, period: int) -> int | None:
    """How far before ``end`` the first region holds the period that stands in the second from ``end`` on."""
    size = words.itemsize
    held, wanted = words[end - 2 * period : end].tobytes(), words[end : end + period].tobytes()
    at = held.find(wanted)
    while at >= 0 and at % size:
        at = held.find(wanted, at + 1)
    return None if at < 0 else 2 * period - at // size


def _joining_runs(words: np.ndarray, regions: Runs, scale: int) -> Runs:
    """Runs with a period of 3 to 6 scales that join two regions of one much smaller period.

    In the first region the run's words equal those a period later in the second. Where they stop to is where one of
    the regions ends; only if both do at once may the run go on.
    """
    regions = regions[regions[:, 1] - regions[:, 0] >= 3 * scale]
    regions = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
    beside = np.flatnonzero((regions[1:, 2] == regions[:-1, 2]) & (regions[1:, 0] <= regions[:-1, 1]))
    found = [_NO_RUNS]
    for k in beside.tolist():
        (s1, e1, p), (s2, e2, _) = regions[k].tolist(), regions[k + 1].tolist()
        shift = _phase(words, e1, p) if e1 + p <= e2 else None
        if shift is None:
            continue
        first = shift + max(0, -(-(3 * scale - shift) // p)) * p
        period = np.arange(first, min(6 * scale, e1 - s1 + 1), p)
        start, end = np.maximum(s1, s2 - period), np.minimum(e1 + period, e2)
        for sides, way in ((period == s2 - s1, -1), (period == e2 - e1, 1)):
            at = start[sides] - 1 if way < 0 else end[sides] - period[sides]
            more = _extent(words, at, period[sides], way)
            (start if way < 0 else end)[sides] += way * more
        runs = np.stack([start, end, period], axis=1)
        found.append(runs[end - start >= 2 * period])
    return np.concatenate(found)


def runs_of(words: np.ndarray, reach: Sequence[int]) -> Runs:
    """All runs of ``words`` (start, end, smallest period), by their ends.

    Texts stand one behind the other, the longest first, before, between and behind them words that stand nowhere
    else; ``reach`` says where each text ends.
    """
    lengths = np.diff(reach, prepend=0) - 1
    runs = _smallest(_short_periods(words, 3 * FIRST_SCALE - 1))
    hashes, width = _joined(words.astype(np.uint64), np.uint64(1)), 1
    scale = FIRST_SCALE
    while True:
        texts = int((lengths >= 6 * scale).sum())
        if not texts:
            break
        end = reach[texts - 1] + 1
        while width < scale:
            hashes = hashes[: end - width + 1]
            hashes = _joined(hashes[:-width], hashes[width:])
            width *= 2
        hashes = hashes[: end - scale + 1]
        contexts = _joined(hashes[:-scale], hashes[scale:])
        regions = runs[(runs[:, 2] <= scale // 3) & (runs[:, 1] - runs[:, 0] >= scale) & (runs[:, 0] < end)]
        at = _synchronising(hashes, scale, regions)
        found = _proposed_runs(words, *_proposals(at, contexts[at], scale), scale)
        joining = _joining_runs(words, regions, scale)
        if len(found) or len(joining):
            runs = _smallest(np.concatenate([runs, found, joining]))
        hashes, width, scale = contexts, 2 * width, 2 * scale
    return runs[runs[:, 1] - runs[:, 0] >= LEAST_WORDS]


def detected(texts: Sequence[str | None]) -> list[tuple[np.ndarray, bytes]]:
    """For each text its runs as rows of (start, length, period), by start and period, and its words without what
    repeats, joined by spaces."""
    split = [(t or "").encode().split() for t in texts]
    order = sorted(range(len(split)), key=lambda i: -len(split[i]))
    flat = list(chain.from_iterable(split[i] for i in order))
    numbers = dict(zip(dict.fromkeys(flat), count()))
    sizes = np.array([len(split[i]) for i in order], dtype=np.int64)
    reach = np.cumsum(sizes + 1)
    words = np.empty(len(flat) + len(order) + 1, dtype=np.int32)
    breaks = np.append(0, reach)
    words[breaks] = -1 - np.arange(len(breaks))
    inside = np.ones(len(words), dtype=bool)
    inside[breaks] = False
    words[inside] = np.fromiter(map(numbers.__getitem__, flat), np.int32, len(flat))
    runs = runs_of(words, reach)
    owner = np.searchsorted(reach, runs[:, 0])
    bounds = np.searchsorted(owner, np.arange(len(order) + 1))
    found: list = [None] * len(order)
    for place, i in enumerate(order):
        own = runs[bounds[place] : bounds[place + 1]]
        if not len(own):
            found[i] = (own, b" ".join(split[i]))
            continue
        base = breaks[place] + 1
        dropped = np.zeros(len(split[i]) + 1, dtype=np.int64)
        np.add.at(dropped, own[:, 0] + own[:, 2] - base, 1)
        np.add.at(dropped, own[:, 1] - base, -1)
        kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
        own = np.stack([own[:, 0] - base, own[:, 1] - own[:, 0], own[:, 2]], axis=1)
        own = own[np.lexsort((own[:, 2], own[:, 0]))]
        found[i] = (own, b" ".join([split[i][k] for k in kept.tolist()]))
    return found


def with_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """docs with ``runs``, (start, length, period) in words of each text's runs, and ``collapsed``.

    Words are what stands between white space of ASCII. A run has at least LEAST_WORDS words and two smallest periods,
    and no neighbouring word extends it; they come by start and period. ``collapsed`` is the text's words, one space
    between them, without those that some run holds behind its first period. Null and empty texts have no runs and
    an empty ``collapsed``; texts are never cut, repeated rows stay, columns that have the names of the new ones are
    replaced, an empty table gives an empty result. Each text is worked on alone, beside others of its batch.
    """
    def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return slices(batch, byte_sizes(batch.column(text)), GROUP_BYTES)

    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [x for part in groups(batch) for x in detected(part.column(text).to_pylist())]
            rows = np.concatenate([_NO_RUNS, *(runs for runs, _ in found)])
            ends = np.cumsum([0, *(len(runs) for runs, _ in found)], dtype=np.int32)
            spans = pa.StructArray.from_arrays(
                [pa.array(rows[:, c]) for c in range(3)], fields=[pa.field(f.name, pa.int64(), False) for f in RUN])
            item = pa.field("element", spans.type, False)
            runs = pa.ListArray.from_arrays(ends, spans, type=pa.list_(item))
            return [runs, pa.array([c for _, c in found], pa.binary()).cast(pa.string())]

        return compute

    return add_columns(docs, text, FIELDS, make, keep)
