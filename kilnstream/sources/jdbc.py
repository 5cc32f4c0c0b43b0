"""Relational tables: scans, views and appends.

``options`` are the connection options of Spark's JDBC source (``url``,
``user``, ``password``, ``driver``); nothing is built in.
"""

from pyspark.sql import DataFrame, SparkSession

from kilnstream import schemas


def read_table(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 1,
) -> DataFrame:
    """A table; with a numeric ``partition_column`` it is read by that many tasks."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is None or num_partitions < 2:
        return reader.option("dbtable", table).load()
    low, high = (
        spark.read.format("jdbc").options(**options)
        .option("query", f"SELECT MIN({partition_column}) AS low_v, "
                         f"MAX({partition_column}) AS high_v FROM {table}")
        .load().first()
    )
    if low is None:
        return reader.option("dbtable", table).load()
    return (
        reader.option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", int(low))
        .option("upperBound", int(high) + 1)
        .option("numPartitions", num_partitions)
        .load()
    )


def read_site_rows(
    spark: SparkSession, options: dict[str, str], table: str, site: str, columns: list[str]
) -> DataFrame:
    """Rows of one site; filter and columns are pushed to the store."""
    rows = read_table(spark, options, table)
    return rows.where(rows["site_id"] == site).select(*columns)


def read_masters(
    spark: SparkSession,
    options: dict[str, str],
    site: str,
    asset_table: str = "tb_bigdata_asset",
    tag_table: str = "tb_bigdata_asset_tag",
    code_table: str = "tb_common_code",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Asset and tag scans of one site, and the codes: what ``assets.load_masters`` takes."""
    assets = read_site_rows(spark, options, asset_table, site, schemas.ASSET_SCAN_COLUMNS)
    tags = read_site_rows(spark, options, tag_table, site, schemas.TAG_LIMIT_SCAN_COLUMNS)
    return assets, tags, read_table(spark, options, code_table).select(*schemas.CODE.names)


def register_view(rows: DataFrame, view: str) -> None:
    """Make a table read by ``read_table`` known to ``spark.sql``.

    SELECT pushes its filters to the store; INSERT INTO appends to the table.
    """
    rows.createOrReplaceTempView(view)


def append(rows: DataFrame, options: dict[str, str], table: str, **write_options) -> None:
    (rows.write.format("jdbc").options(**options).options(**write_options)
     .option("dbtable", table).mode("append").save())


def overwrite_rows(rows: DataFrame, options: dict[str, str], table: str, **write_options) -> None:
    """Replace the rows of a table and keep the table itself."""
    (rows.write.format("jdbc").options(**options).options(**write_options)
     .option("dbtable", table).option("truncate", True).mode("overwrite").save())
