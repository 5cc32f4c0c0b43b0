"""Computing an expensive column once."""

from pyspark.sql import DataFrame

from kilnstream.functions.text import quoted


def once(rows: DataFrame, **columns: str) -> DataFrame:
    """Add columns (SQL text) that later filters and projections do not compute again.

    Catalyst merges projections and moves filters below them, copying the
    expressions of the columns they use; a JSON parse would then run several
    times per row.  It does not do so across a generator, so the columns are
    produced by one that always emits exactly one row.
    """
    fields = ", ".join(f"{quoted(name)}, {column}" for name, column in columns.items())
    return rows.selectExpr("*", f"inline(array(named_struct({fields})))")
