"""Labelled rows for training: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled documents that a model is fitted on at most, the first by a hash of their ids. All rows are scored.
TRAINING_ROWS = 20_000


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label is never learned from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _order(id_col: str) -> Column:
    return F.xxhash64(F.lit(11), id_col)


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` of the rows, the first by a hash of the key.

    A threshold on the hash that about four times as many rows pass keeps what the tasks hand over from growing with
    the table.
    """
    share = 4 * most / max(1, rows.count())
    if share < 1:
        rows = rows.filter(_order(key) < F.lit(round((2 * share - 1) * 2**63)))
    return rows.orderBy(_order(key), key).limit(most)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAINING_ROWS,
                  id_col: str = "doc_id") -> DataFrame:
    """docs that have a 0 or 1 as label and are not held out, with the label as ``target``.

    An id with several labels counts with the larger one. At most ``rows`` ids are chosen, by a hash; that table
    of an id and a number each is broadcast.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = sampled(usable.groupBy(id_col).agg(F.max(label).alias("target")), id_col, rows)
    return docs.drop("target").join(F.broadcast(chosen), id_col)


def first_rows(sample: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id") -> DataFrame:
    """The first of the rows by the same hash; bounds the sample where an id stands on many rows."""
    return sample.orderBy(_order(id_col), id_col).limit(rows)
