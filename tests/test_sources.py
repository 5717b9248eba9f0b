import pytest
from pyspark.sql import functions as F

from invoicelake.schema import BRONZE
from invoicelake.session import shared_folder, stage
from invoicelake.sources import catalog, landing
from invoicelake.sources.catalog import (
    create_schema, preview, publish_table, register_gold_folder, save_parquet, save_table)
from invoicelake.sources.landing import read_landing, read_text_extract, union_extracts, with_audit


def test_every_file_of_the_folder_with_its_origin(spark, bronze, tmp_path):
    for part in ("one", "two"):
        bronze.limit(3).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
    df = with_audit(spark, str(tmp_path / "landing"))
    assert df.count() == 6 and df.select("_source_file").distinct().count() == 2
    assert df.filter("_ingested_at IS NULL").count() == 0
    assert read_landing(spark, str(tmp_path / "landing")).schema == BRONZE


def test_extracts_are_stacked_by_position(spark, bronze, tmp_path):
    bronze.toDF(*"ABCDEFGH").write.csv(str(tmp_path / "csv"), header=True, ignoreLeadingWhiteSpace=False,
                                       ignoreTrailingWhiteSpace=False)
    bronze.toDF(*[f"c {i}" for i in range(8)]).write.parquet(str(tmp_path / "pq"))
    both = union_extracts([read_text_extract(spark, str(tmp_path / "csv")),
                           read_text_extract(spark, str(tmp_path / "pq"), "parquet")])
    assert both.columns == BRONZE.names and both.exceptAll(bronze.unionAll(bronze)).count() == 0
    assert both.count() == 24
    bronze.select("invoice").write.parquet(str(tmp_path / "narrow"))
    with pytest.raises(ValueError):
        read_text_extract(spark, str(tmp_path / "narrow"), "parquet")


def test_tables_are_overwritten_and_documented(spark):
    create_schema(spark, "shop", "it's a shop")
    save_table(spark.range(3), "shop.t", "first")
    stored = save_table(spark.range(2).selectExpr("id", "'x' AS extra"), "shop.t", "it's \\ second")
    assert stored.columns == ["id", "extra"] and stored.count() == 2
    assert preview(spark, "shop.t", 1).count() == 1
    comment = spark.sql("DESCRIBE TABLE EXTENDED shop.t").filter("col_name = 'Comment'").first().data_type
    assert comment == "it's \\ second"


def test_gold_folder_as_views(spark, tmp_path):
    save_parquet(spark.range(4), str(tmp_path / "gold_a"))
    save_parquet(spark.range(5), str(tmp_path / "gold_b"))
    spark.range(1).write.json(str(tmp_path / "run_report"))
    assert register_gold_folder(spark, str(tmp_path), ["gold_a"]) == ["gold_a"]
    assert spark.sql("SELECT COUNT(*) AS n FROM gold_a").first().n == 4
    assert register_gold_folder(spark, str(tmp_path)) == ["gold_a", "gold_b"]
    assert spark.sql("SELECT COUNT(*) AS n FROM gold_b").first().n == 5


def test_a_failed_write_leaves_the_published_rows(spark):
    create_schema(spark, "published")
    publish_table(spark.range(2), "published.gold_t", "it's first")
    with pytest.raises(Exception, match="no rows today"):
        publish_table(spark.range(3).selectExpr("id", "raise_error('no rows today') AS extra"), "published.gold_t", "second")
    assert spark.table("published.gold_t").count() == 2
    for rows in (3, 4, 5):
        seen = publish_table(spark.range(rows).selectExpr("id", "'x' AS extra"), "published.gold_t", "third")
        assert seen.columns == ["id", "extra"] and seen.count() == rows
    assert spark.table("published.gold_t").count() == 5
    assert len([t for t in spark.catalog.listTables("published") if t.name.startswith("gold_t_")]) == 2


def test_stage_reads_back_what_it_wrote(spark, silver):
    stored = stage(silver, "silver")
    assert stored.schema == silver.schema and stored.exceptAll(silver).count() == 0
    assert shared_folder(spark) in stored.inputFiles()[0]


def test_version_clean_up_leaves_other_tables_alone(spark):
    from invoicelake.sources.catalog import create_schema, drop_old_versions, save_table
    create_schema(spark, "versions")
    versions = [f"lines_{day:020d}" for day in (1, 2, 3)]
    for name in ("lines_archive", "lines_backup", *versions):
        save_table(spark.range(1), f"versions.{name}", "test")
    drop_old_versions(spark, "versions", "lines_")
    left = {t.name for t in spark.catalog.listTables("versions") if t.name.startswith("lines_")}
    assert left == {"lines_archive", "lines_backup", *versions[1:]}


def test_damaged_lines_are_kept_apart(spark, tmp_path):
    from invoicelake.sources.landing import damaged_lines, read_extract_lines, read_text_extract
    (tmp_path / "a.csv").write_text(
        'Invoice,Code,What,Units,On,At,For,In\n'
        '1,71001,"two\nlines, ""quoted""",4,2015-01-01,2.5,,Norway\n'
        '2,71001,cut short\n'
        '"","71002"," ",,2015-01-01,2.5,c,Norway\n')
    (tmp_path / "b.csv").write_text(
        'Nummer;x,B,C,D,E,F,G\n'
        '3,71001,t,4,2015-01-01,2.5,c,Norway\n'
        '4,71001,t,4,2015-01-01,2.5,c,Norway,one more\n')
    extract = read_extract_lines(spark, str(tmp_path))
    assert sorted(r._damaged for r in damaged_lines(extract).collect()) == [
        "2,71001,cut short", "4,71001,t,4,2015-01-01,2.5,c,Norway,one more"]
    assert all(r.invoice is None and r.country is None for r in damaged_lines(extract).collect())
    good = read_text_extract(spark, str(tmp_path))
    rows = sorted(good.collect(), key=lambda r: r.invoice or "")
    assert [r.invoice for r in rows] == [None, "1", "3"] and good.count() == 3
    assert rows[1].description == 'two\nlines, "quoted"' and rows[1].customer_id is None
    assert (rows[0].stock_code, rows[0].quantity) == ("71002", None)
    assert good.select("country").distinct().count() == 1      # whatever a query asks for, the same lines are damaged


def test_files_are_reconciled_with_bronze(spark, bronze, tmp_path):
    folder = str(tmp_path / "landing")
    bronze.limit(4).coalesce(1).write.parquet(folder)
    first = landing.landing_key(spark, folder)
    loaded = stage(landing.with_audit(spark, folder), "loaded")
    assert landing.landing_key(spark, folder) == first
    bronze.limit(3).coalesce(1).write.mode("append").parquet(folder)
    bronze.limit(0).coalesce(1).write.mode("append").parquet(folder)
    assert landing.landing_key(spark, folder) != first
    files = landing.landing_manifest(spark, folder)
    assert sorted(r.rows for r in files.collect()) == [0, 3, 4] and files.filter("bytes <= 0 OR modified IS NULL").isEmpty()
    file = loaded.first()._source_file
    odd = loaded.filter("stock_code <> 'POST'").limit(2).unionByName(loaded.limit(1).withColumn("_source_file", F.lit("old")))
    fate = lambda rows: {
        (r.status, r.landed_rows, r.bronze_rows) for r in landing.reconcile(files, rows).collect()}
    assert fate(loaded) == {("loaded", 4, 4), ("missing", 3, None), ("loaded", 0, None)}
    assert fate(odd) == {("differs", 4, 2), ("missing", 3, None), ("loaded", 0, None), ("gone", None, 1)}
    empty = str(tmp_path / "empty")
    bronze.limit(0).write.parquet(empty)
    assert {r.rows for r in landing.landing_manifest(spark, empty).collect()} <= {0}
    assert landing.landing_status(landing.landing_manifest(spark, empty), loaded.limit(0)).agg(
        F.sum("bronze_rows")).first()[0] in (0, None)


def test_comments_travel_with_columns(spark):
    create_schema(spark, "described")
    df = catalog.documented(spark.range(3).selectExpr("id", "nullif(id, 1) AS `odd name`"), {"odd name": "it's \\ odd"})
    publish_table(df, "described.gold_t", "a table")
    found = catalog.data_dictionary(spark, "described", ["gold_t"]).collect()
    assert {(r.column_name, r.comment, r.filled) for r in found} == {("id", None, 3), ("odd name", "it's \\ odd", 2)}
    assert catalog.finished(spark, "described.gold_t", "") and not catalog.finished(spark, "described.gold_t", "x")
    assert not catalog.finished(spark, "described.other", "")
