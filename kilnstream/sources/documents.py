"""Document collections: scan and save."""

from pyspark.sql import DataFrame, SparkSession


def read_documents(
    spark: SparkSession, path: str, form: str = "json", schema: str | None = None, **options
) -> DataFrame:
    """A collection with its schema inferred, unless one is given.

    ``form`` is any Spark source name, so a document-store connector on the
    class path is used by naming it and passing its options.
    """
    reader = spark.read.format(form).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def save_documents(rows: DataFrame, path: str, form: str = "json", **options) -> None:
    """Append rows to a collection."""
    writer = rows.write.format(form).options(**options).mode("append")
    writer.save(path) if path else writer.save()
