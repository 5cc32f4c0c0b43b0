"""Labelled rows for fitting, of bounded number and size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps into which row hashes are dealt for sampling.
STEPS = 1 << 30
#: Characters of a piece of a longer text.
PIECE = 300


def remainder(modulus: int):
    """``crc32`` of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def spread(text: str, most_chars: int):
    """The text, or pieces of whole words from all over it if it is longer."""
    last = max(1, most_chars // PIECE - 1)
    return F.expr(rf"""
        if(length({text}) <= {most_chars}, {text}, array_join(transform(sequence(0L, {last}L),
            i -> regexp_replace(
                substring({text}, 1 + cast(i * (length({text}) - {PIECE}) div {last} AS int), {PIECE}),
                r'^\S+\s|\s\S+$', '')), ' '))
    """)


def bounded(rows: DataFrame, label: str, most: int, most_chars: int) -> list[tuple]:
    """About ``most`` rows of every label value, or all where there are fewer.

    ``rows`` have ``doc_id``, ``text`` and the label.  A row is taken by the hash
    of its id, so the choice does not depend on how the rows are dealt out; no
    label's rows meet in one task.  Longer texts are cut to pieces from all over them
    before they leave their task.  The result is ordered.
    """
    shares = {row[0]: min(1.0, most / row[1]) for row in rows.groupBy(label).count().collect()}
    taken = F.lit(0)
    for value, share in shares.items():
        taken = F.when(F.col(label) == F.lit(value), int(share * STEPS)).otherwise(taken)
    picked = rows.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(STEPS)) < taken)
    texts = spread("text", most_chars).alias("text")
    return sorted(map(tuple, picked.select("doc_id", texts, label).collect()),
                  key=lambda row: (str(row[0]), row[1], str(row[2])))
