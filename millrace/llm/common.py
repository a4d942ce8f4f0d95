"""What the operators share: whole-text columns, tables in the shared folder, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.graphs import components, materialize, release
from millrace.session import shared_folder, table

__all__ = ["batches", "components", "fresh", "materialize", "release", "shared_folder", "table", "whole_text"]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it a column that df does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(name: str = "text") -> Column:
    """The text as a string, null taken as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def batches(stream, rows: int = 512, chars: int = 4_000_000, text: str = "text"):
    """Arrow batches cut so that Python holds few texts at once; a single longer text comes alone."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in stream:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, before + chars, side="right"))))
            yield batch.slice(start, stop - start)
            start = stop
