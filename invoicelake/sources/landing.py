"""Reading extracts as received: every column is text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoicelake.schema import BRONZE


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files of a folder (or one file) under the declared text schema."""
    return spark.read.schema(BRONZE).parquet(path)


def with_audit(spark: SparkSession, path: str) -> DataFrame:
    """The landed rows with the file each came from and the time of ingestion."""
    return (
        read_landing(spark, path)
        .select("*", F.col("_metadata.file_path").alias("_source_file"))
        .withColumn("_ingested_at", F.current_timestamp())
    )


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, modified) of every file of a landing folder, from the listing alone: no content is read."""
    return (
        spark.read.format("binaryFile").load(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"),
                F.col("modificationTime").alias("modified")))


def landing_key(spark: SparkSession, path: str) -> str:
    """A text that changes whenever a file of the folder is added, removed, replaced or rewritten."""
    row = landed_files(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.sum(F.xxhash64("file", "bytes", "modified").cast("decimal(20,0)")).alias("digest")).first()
    return f"{row.files}-{row.bytes}-{row.digest}"


def landing_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Name, size, time and number of rows of every landed file; a file without rows has 0."""
    rows = read_landing(spark, path).select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(
        F.count("*").alias("rows"))
    return landed_files(spark, path).join(rows, "file", "left").fillna(0, ["rows"])


def reconcile(manifest: DataFrame, bronze: DataFrame) -> DataFrame:
    """What became of each file: ``loaded`` whole, ``missing`` from bronze, ``gone`` from the folder since it was loaded,
    or ``differs`` in rows. A landed file without rows counts as loaded."""
    loaded = bronze.groupBy(F.col("_source_file").alias("file")).agg(F.count("*").alias("bronze_rows"))
    landed = manifest.withColumnRenamed("rows", "landed_rows")
    status = (
        F.when(F.col("landed_rows").isNull(), "gone")
        .when(F.col("landed_rows") == F.coalesce("bronze_rows", F.lit(0)), "loaded")
        .when(F.col("bronze_rows").isNull(), "missing").otherwise("differs"))
    return landed.join(loaded, "file", "full").withColumn("status", status)


def landing_status(manifest: DataFrame, bronze: DataFrame) -> DataFrame:
    """Rows landed and loaded, per fate of their files."""
    return reconcile(manifest, bronze).groupBy("status").agg(
        F.coalesce(F.sum("landed_rows"), F.lit(0)).alias("landed_rows"),
        F.coalesce(F.sum("bronze_rows"), F.lit(0)).alias("bronze_rows"))


DAMAGED = "_damaged"


def read_extract_lines(spark: SparkSession, path: str, fmt: str = "csv", quoted_breaks: bool = True) -> DataFrame:
    """All lines of one extract (a file or a folder of files, each with whatever headings it has), as text by position.

    A line without exactly the declared number of cells is kept whole in ``_damaged`` and has no cells; of all other
    lines ``_damaged`` is NULL and blank cells are NULL. ``quoted_breaks`` reads line breaks inside quotes as text; Spark
    then reads each file in one task, so turn it off for large files known to have none.
    """
    if fmt == "csv":
        # An all-text schema by position: headings are skipped, types never guessed. All cells are parsed whatever a query
        # needs, since a line is damaged or not whatever is asked of it.
        lines = T.StructType([*BRONZE.fields, T.StructField(DAMAGED, T.StringType())])
        raw = spark.read.schema(lines).option("columnPruning", "false").csv(
            path, header=True, enforceSchema=True, quote='"', escape='"', multiLine=quoted_breaks, mode="PERMISSIVE",
            columnNameOfCorruptRecord=DAMAGED)
    else:
        raw = spark.read.format(fmt).load(path)
        if len(raw.columns) != len(BRONZE):
            raise ValueError(f"{path}: {len(raw.columns)} columns, expected {len(BRONZE)}")
        raw = raw.select([F.col(f"`{c}`").cast(T.StringType()) for c in raw.columns]).toDF(*BRONZE.names).withColumn(
            DAMAGED, F.lit(None).cast(T.StringType()))
    # Spark refuses to read nothing but the damaged lines, as in a count; a second column in the condition lets it
    damaged = F.coalesce(F.col(DAMAGED), F.when(F.length(BRONZE.names[0]) < 0, F.lit("")))
    return raw.select(*[
        F.when(F.col(DAMAGED).isNull(), F.nullif(F.col(c), F.lit(""))).alias(c) for c in BRONZE.names], damaged.alias(DAMAGED))


def read_text_extract(spark: SparkSession, path: str, fmt: str = "csv", quoted_breaks: bool = True) -> DataFrame:
    """The whole lines of one extract; see ``damaged_lines`` for the rest."""
    return read_extract_lines(spark, path, fmt, quoted_breaks).filter(F.col(DAMAGED).isNull()).drop(DAMAGED)


def damaged_lines(extract: DataFrame) -> DataFrame:
    """The lines an extract holds that are no lines of the declared table, as they were found: they go to quarantine."""
    return extract.filter(F.col(DAMAGED).isNotNull())


def union_extracts(extracts: list[DataFrame]) -> DataFrame:
    """Stack extracts (UNION ALL), keeping duplicates for the silver step to remove."""
    return reduce(DataFrame.unionByName, extracts)
