"""Table DDL and commits: create, widen, properties, partition switches.

A parquet table has no row-level MERGE, so a merge batch writes new partition
folders aside and the catalog is then pointed at them. One statement on the
table's properties commits the batch; the switch that follows can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.types import quote, sql_string  # noqa: F401  (re-exported)


def ident(database: str, name: str) -> str:
    """Quoted table name; ``database`` may carry a catalog, as ``catalog.database``."""
    return ".".join(quote(part) for part in [*database.split("."), name])


def table_exists(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.tableExists(ident(database, name))


def create_table(
    spark: SparkSession,
    table: str,
    columns: list[tuple[str, str]],
    partition_by: list[str],
    location: str | None,
    using: str = "parquet",
    properties: dict[str, str] | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """CREATE TABLE IF NOT EXISTS with every identifier quoted; returns the SQL.

    ``partition_by`` holds quoted columns or transforms. Without a ``location``
    the catalog places the table. ``options`` hold for every write to it.
    """
    cols = ", ".join(f"{quote(n)} {t}" for n, t in columns)
    sql = f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING {using}"
    if options:
        sql += " OPTIONS (" + ", ".join(f"{sql_string(k)}={sql_string(v)}" for k, v in options.items()) + ")"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(partition_by) + ")"
    if location:
        sql += f" LOCATION {sql_string(location)}"
    if properties:
        sql += " TBLPROPERTIES (" + ", ".join(f"{sql_string(k)}={sql_string(v)}" for k, v in properties.items()) + ")"
    spark.sql(sql)
    return sql


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS " + ".".join(quote(part) for part in database.split(".")))


def add_columns(spark: SparkSession, table: str, columns: list[tuple[str, str]]) -> str | None:
    if not columns:
        return None
    sql = f"ALTER TABLE {table} ADD COLUMNS (" + ", ".join(f"{quote(n)} {t}" for n, t in columns) + ")"
    spark.sql(sql)
    return sql


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {table}")


def property_map(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in table_properties(spark, table).collect()}


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    """One catalog statement for all of them, so they change together."""
    pairs = ", ".join(f"{sql_string(k)}={sql_string(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def _path(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def written_folders(spark: SparkSession, path: str, columns: list[str]) -> dict[tuple[str, ...], str]:
    """Partition values -> folder of a partitioned folder (one listing of folders, no file names); none where there is none."""
    fs, _ = _path(spark, path)
    _, pattern = _path(spark, path + "".join(f"/{c}=*" for c in columns))
    out = {}
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath().toString()
        out[tuple(part.split("=", 1)[1] for part in folder.split("/")[-len(columns) :])] = folder
    return out


def make_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, p = _path(spark, path)
        fs.mkdirs(p)


def _spec(columns: list[str], values) -> str:
    return "PARTITION (" + ", ".join(f"{quote(c)}={sql_string(v)}" for c, v in zip(columns, values)) + ")"


def live_partitions(spark: SparkSession, table: str, column: str, values: list[str]) -> list[tuple[str, ...]]:
    """Partitions registered in the catalog with one of the given values of a partition column (metadata only)."""
    out = []
    for value in values:
        for row in spark.sql(f"SHOW PARTITIONS {table} {_spec([column], [value])}").collect():
            out.append(tuple(part.split("=", 1)[1] for part in row[0].split("/")))
    return out


def switch_partitions(
    spark: SparkSession, table: str, columns: list[str], adds: list[list], drops: list[list]
) -> None:
    """Add the new partitions, then drop the replaced ones: two catalog statements
    whatever their number. Idempotent (IF NOT EXISTS / IF EXISTS)."""
    if adds:
        specs = [f"{_spec(columns, values)} LOCATION {sql_string(location)}" for values, location in adds]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(specs))
    if drops:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(_spec(columns, values) for values in drops))
    spark.catalog.refreshTable(table)
