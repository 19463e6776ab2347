"""Notes on a series, each once, in the order in which they were first made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def notes_in_order(messages: DataFrame, keys: tuple[str, ...], order: str = "position", note: str = "note", separator: str = "; ") -> DataFrame:
    """(keys, n_notes, notes): the different notes of a series by their first position, ties by their text, as one text.

    Notes that repeat merge to their first position on the way, before and after rows move; only different
    notes of a series meet in one row. Null and empty notes do not count, and a note without a position comes
    last; a series without a note has an empty text.
    """
    told = F.col(note).isNotNull() & (F.col(note) != "")
    firsts = messages.groupBy(*keys, F.when(told, F.col(note)).alias("_note")).agg(F.min(order).alias("_first"))
    entry = F.when(F.col("_note").isNotNull(), F.struct(F.col("_first").isNull().alias("last"), "_first", F.col("_note").alias("note")))
    listed = firsts.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_notes"))
    return listed.select(*keys, F.size("_notes").alias("n_notes"), F.array_join(F.transform("_notes", lambda x: x["note"]), separator).alias("notes"))
