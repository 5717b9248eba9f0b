"""Catalog tables, documented tables and named views."""

from __future__ import annotations

import datetime as dt
import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_KEY, STAGE_VERSION = "invoicelake.stage_key", "invoicelake.version"


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def documented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The columns with their comments as field metadata, which tables and views carry on."""
    return df.select([
        F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata | {"comment": comments[f.name]})
        if f.name in comments else F.col(f"`{f.name}`") for f in df.schema.fields])


def column_docs(spark: SparkSession, schema: str, names: list[str] | None = None) -> DataFrame:
    """(table_name, column_name, type, comment) as the catalog knows them; one row per column of the schema's tables."""
    names = sorted(t.name for t in spark.catalog.listTables(schema)) if names is None else names
    rows = [(name, c.name, c.dataType, c.description)
            for name in names for c in spark.catalog.listColumns(f"{schema}.{name}")]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string, comment string")


def data_dictionary(spark: SparkSession, schema: str, names: list[str]) -> DataFrame:
    """``column_docs`` and how many rows hold a value: one pass over each table."""
    filled = []
    for name in names:
        table = spark.table(f"{schema}.{name}")
        counts = table.agg(*[F.count(f"`{c}`").alias(c) for c in table.columns])
        filled.append(counts.unpivot([], table.columns, "column_name", "filled").withColumn("table_name", F.lit(name)))
    rows = filled[0]
    for more in filled[1:]:
        rows = rows.unionByName(more)
    return column_docs(spark, schema, names).join(rows, ["table_name", "column_name"])


def create_schema(spark: SparkSession, schema: str, comment: str = "") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)} COMMENT '{_text(comment)}'")


def save_table(
    df: DataFrame, name: str, comment: str, mode: str = "overwrite", partition_by: str | None = None
) -> DataFrame:
    """Overwrite a managed table (its schema may change), document it, and return it as stored."""
    spark = df.sparkSession
    writer = df.write.mode(mode).format("parquet")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS '{_text(comment)}'")
    return spark.table(name)


def preview(spark: SparkSession, name: str, rows: int = 10) -> DataFrame:
    """A few rows of a stored table to look at."""
    return spark.table(name).limit(rows)


def save_view(
    spark: SparkSession, name: str, table: str, columns: list[str], condition: str, comment: str, key: str = ""
) -> DataFrame:
    """Point a documented view at a part of a stored table, in one step for its readers.

    The view names the version it shows and the ``key`` of the inputs and parameters it was made from."""
    listed = ", ".join(f"`{c}`" for c in columns)
    comments = {f.name: f.metadata.get("comment", "") for f in spark.table(table).schema.fields}
    described = ", ".join(f"`{c}` COMMENT '{_text(comments[c])}'" if comments[c] else f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} ({described}) COMMENT '{_text(comment)}' "
        f"TBLPROPERTIES ('{STAGE_KEY}' = '{_text(key)}', '{STAGE_VERSION}' = '{_text(table)}') AS "
        f"SELECT {listed} FROM {_quoted(table)} WHERE {condition}")
    return spark.table(name)


def stage_key(*parts: object) -> str:
    """One text for the inputs and parameters of a stage."""
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def finished(spark: SparkSession, name: str, key: str) -> bool:
    """Whether the view shows rows made from these inputs and parameters, and the version they are in still exists."""
    if not spark.catalog.tableExists(name):
        return False
    found = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}
    return found.get(STAGE_KEY) == key and spark.catalog.tableExists(found.get(STAGE_VERSION, ""))


def version_name(name: str) -> str:
    """A new version of a table: its name and the time, in 20 digits."""
    return f"{name}_{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"


def publish_table(df: DataFrame, name: str, comment: str, key: str = "") -> DataFrame:
    """Write a version of its own and point the documented view ``name`` at it; ``key`` is kept with the view.

    Readers keep the old rows until the new ones are whole, and a failed write loses nothing."""
    spark, version = df.sparkSession, version_name(name)
    save_table(df, version, comment)
    view = save_view(spark, name, version, df.columns, "TRUE", comment, key)
    schema, table = name.rsplit(".", 1)
    drop_old_versions(spark, schema, f"{table}_")
    return view


def drop_old_versions(spark: SparkSession, schema: str, prefix: str, keep: int = 2) -> None:
    """Drop all but the newest versions; one older version stays for queries still reading it. Call it right after
    publishing, when the newest version is the one its view shows.

    A version is named by the prefix and a time stamp of 20 digits; other tables of the schema are left alone."""
    version = re.compile(re.escape(prefix) + r"\d{20}")
    names = sorted(t.name for t in spark.catalog.listTables(schema) if version.fullmatch(t.name))
    for name in names[:-keep]:
        spark.sql(f"DROP TABLE {_quoted(f'{schema}.{name}')}")


def save_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables readable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_gold_folder(spark: SparkSession, folder: str, names: list[str] | None = None) -> list[str]:
    """Views on the Parquet folders of a gold folder: the named ones, or all whose names begin with ``gold_``."""
    if names is None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()]
        names = sorted(n for n in found if n.startswith("gold_"))
    register_views({name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in names})
    return names
