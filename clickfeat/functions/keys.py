"""Key building.  Keys stay typed columns inside the engine; string keys are
made only where a key-value table is published."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickfeat.functions.text import query_key


def composite_key(*cols) -> Column:
    """``a_b_c`` from typed columns (only for export)."""
    return F.concat_ws("_", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def query_id_key(query_col, id_col) -> Column:
    """``query_key(query) + '_' + id``."""
    q = F.col(query_col) if isinstance(query_col, str) else query_col
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.concat_ws("_", query_key(q), i.cast("string"))
