"""One stream, two sinks: raw records to Bronze, parsed trades to the hot table."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from tapeworks.operators.hot import storable, to_hot, unstorable
from tapeworks.operators.quality import counted
from tapeworks.operators.silver import LINEAGE
from tapeworks.schemas import HOT_TRADE
from tapeworks.sources.envelope import to_bronze
from tapeworks.streaming.runs import start_batches

BatchWriter = Callable[[DataFrame, int], None]
Report = Callable[[int, dict[str, int]], None]

_log = logging.getLogger(__name__)


def _log_counts(batch_id: int, counts: dict[str, int]) -> None:
    _log.info("batch %d: %s", batch_id, ", ".join(f"{n} {name}" for name, n in counts.items()))


def dual_sink_step(
    write_bronze: BatchWriter, write_hot: BatchWriter, write_rejects: BatchWriter | None = None,
    report: Report = _log_counts,
) -> BatchWriter:
    """All writers must replace what they wrote for the same batch before: a failure between them repeats all.

    The batch is parsed once and kept with its payloads, and every sink takes its rows and columns from that. Records
    the hot table cannot store stay in Bronze, and go to the rejects, if these are kept, with what they lack. ``report``
    gets the rows of each sink, counted while they were written.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        parsed = to_hot(batch, keep=tuple(batch.columns)).persist()
        try:
            writes = {
                "bronze": (write_bronze, parsed.select(batch.columns)),
                "hot": (write_hot, storable(parsed).select(HOT_TRADE.fieldNames())),
            }
            if write_rejects is not None:
                lost = unstorable(parsed).select(*HOT_TRADE.fieldNames(), *LINEAGE, "reasons")
                writes["rejects"] = (write_rejects, lost)
            counts = {}
            for name, (write, rows) in writes.items():
                seen = Observation()
                write(counted(rows, seen), batch_id)
                counts[name] = seen.get["rows"]
            counts.setdefault("rejects", counts["bronze"] - counts["hot"])
            report(batch_id, counts)
        finally:
            parsed.unpersist()
    return step


def start_dual_sink(
    envelope: DataFrame, write_bronze: BatchWriter, write_hot: BatchWriter, checkpoint: str,
    trigger: dict | None = None, write_rejects: BatchWriter | None = None, report: Report = _log_counts,
) -> StreamingQuery:
    """The ingestion time is stamped on the stream, before the batch function: a repeated batch keeps it."""
    step = dual_sink_step(write_bronze, write_hot, write_rejects, report)
    return start_batches(to_bronze(envelope), step, checkpoint, trigger)
