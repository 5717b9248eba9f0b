import pytest

from invoicelake.operators.screening import UnsafeSQL, guard, require_read, run_sql, screen_queries

BLOCKED = {
    "DROP TABLE gold_monthly_kpis": "not a SELECT",
    "Delete from gold_monthly_kpis": "not a SELECT",
    "UPDATE gold_customer_rfm SET segment = 'Loyal'": "not a SELECT",
    "SELECT 1; SELECT 2": "several statements or a comment",
    "SELECT 1; ;": "several statements or a comment",
    "SELECT 2 -- and more": "several statements or a comment",
    "SELECT /* quiet */ 2": "several statements or a comment",
    "WITH a AS (SELECT 1) INSERT INTO b SELECT * FROM a": "forbidden word: insert",
    "select * from Read_CSV('/etc/hosts')": "forbidden word: read_csv",
    "SELECTED": "not a SELECT",
    "": "empty text",
    " ;\n": "empty text",
    "``` ```": "empty text",
    "SELECT 'open -- drop": "several statements or a comment",
    r"WITH t AS (SELECT 'a\'' AS a) INSERT INTO victim SELECT * FROM t WHERE '' = ''": "forbidden word: insert",
    "WITH t AS (SELECT 1 AS `'`) INSERT INTO victim SELECT * FROM t WHERE `'` = 1": "forbidden word: insert",
    "WITH t AS (SELECT \"'\" AS a) INSERT INTO victim SELECT * FROM t WHERE a = \"'\"": "forbidden word: insert",
    r"WITH t AS (SELECT r'\' AS a) INSERT INTO victim SELECT ' ' FROM t": "a raw literal and a backslash",
    "SELECT TRANSFORM(id) USING 'cat' AS (x string) FROM shown": "a script",
    "SELECT Reflect('java.lang.System', 'getenv', 'HOME')": "forbidden word: reflect",
    "SELECT * FROM text.`/etc/hostname`": "a table named by a path",
    "SELECT * FROM `TEXT`.`/etc/hostname`": "a table named by a path",
    "SELECT * FROM `org.apache.spark.sql.execution.datasources.text.TextFileFormat`.`/etc/hostname`": "a table named by a path",
    "SELECT * FROM org.apache.spark.sql.execution.datasources.text.TextFileFormat.`/etc/hostname`": "a table named by a path",
    "SELECT `reflect`('java.lang.System', 'setProperty', 'a', 'b')": "forbidden word: reflect",
    "SELECT ` x`, `Java_Method` ('java.lang.System', 'getenv', 'HOME')": "forbidden word: java_method",
}
ALLOWED = {
    "SELECT stock_code FROM p WHERE description LIKE '%USE; DROP -- SET%'": None,
    "SELECT 'it''s; a drop' AS t": None,
    "```sql\nSELECT 1;;\n```": "SELECT 1\nLIMIT 200",
    "```SQL\nSELECT 1\n```": "SELECT 1\nLIMIT 200",
    "  select 1 ;": "select 1\nLIMIT 200",
    "SELECT 1 LIMIT 10": "SELECT 1 LIMIT 10",
    "SELECT 1 limit 200": "SELECT 1 limit 200",
    "SELECT 1 limit 201": "SELECT 1 LIMIT 200",
    "SELECT 1 LIMIT 99999999999999999999999999999999999999999999": "SELECT 1 LIMIT 200",
    "SELECT updated_at, settings FROM t": None,
    "SELECT t.`text. a`, `parquet`, csv.a, 'text.`x`' FROM t csv": None,
    'SELECT "x;y"': None,
    r"SELECT 'it\'s; a drop' AS t": None,
    "SELECT a FROM t JOIN u USING (id)": None,
    "SELECT 1 LIMIT ALL": "SELECT 1 LIMIT 200",
    "SELECT 1 OFFSET 3": "SELECT 1\nLIMIT 200 OFFSET 3",
    "SELECT 1 LIMIT 500 OFFSET 3": "SELECT 1 LIMIT 200 OFFSET 3",
    # the limit is rewritten in the original text, behind a literal of any length
    "SELECT 'a long literal in front of it' AS t LIMIT 5000": "SELECT 'a long literal in front of it' AS t LIMIT 200",
    "SELECT * FROM (SELECT 1 LIMIT 5000)": None,
}


@pytest.fixture(scope="module")
def screened(spark):
    log = spark.createDataFrame([(t,) for t in [*BLOCKED, *ALLOWED]], "sql string")
    return {r.sql: r for r in screen_queries(log).collect()}


@pytest.mark.parametrize("text", BLOCKED)
def test_blocked(screened, text):
    assert (screened[text].blocked_because, screened[text].safe_sql) == (BLOCKED[text], None)


@pytest.mark.parametrize("text", ALLOWED)
def test_allowed(screened, text):
    wanted = ALLOWED[text] or f"{text}\nLIMIT 200"
    assert (screened[text].blocked_because, screened[text].safe_sql) == (None, wanted)


def test_long_texts(spark):
    text = "SELECT '" + "a''" * 50_000 + "' AS t"
    assert guard(spark, text) == f"{text}\nLIMIT 200"


def test_missing_text_is_empty(spark):
    assert screen_queries(spark.createDataFrame([(None,)], "sql string")).first().blocked_because == "empty text"


def test_run_sql(spark):
    tables = {"numbers": spark.range(500)}
    assert run_sql(spark, "SELECT * FROM numbers", tables).count() == 200
    for text, rows in {"LIMIT ALL": 200, "OFFSET 450": 50, "LIMIT 30 OFFSET 480": 20}.items():
        assert run_sql(spark, f"SELECT * FROM numbers {text}", tables).count() == rows
    with pytest.raises(UnsafeSQL):
        run_sql(spark, "DROP VIEW numbers", tables)


MORE_THAN_A_QUERY = [
    r"WITH t AS (SELECT 'a\'' AS a) INSERT INTO victim SELECT * FROM t WHERE '' = ''",
    "SELECT TRANSFORM(id) USING 'cat' AS (x string) FROM shown",
    "SELECT reflect('java.lang.System', 'getenv', 'HOME')",
    "SELECT * FROM text.`/etc/hostname`",
    "SELECT * FROM `TEXT`.`/etc/hostname`",
    "SELECT * FROM `org.apache.spark.sql.execution.datasources.text.TextFileFormat`.`/etc/hostname`",
    "SELECT * FROM shown WHERE EXISTS (SELECT 1 FROM `binaryFile`.`/etc/hostname`)",
    "SELECT * FROM IDENTIFIER('text.`/etc/hostname`')",
    "SELECT `reflect`('java.lang.System', 'setProperty', 'screen.test', 'set')",
    "SELECT (SELECT max(`try_reflect`('java.lang.System', 'getenv', 'HOME')) FROM shown)",
    "SELECT from_json('{}', `java_method`('java.lang.System', 'getenv', 'HOME'))",
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'getenv', 'HOME')",
    "SELECT input_file_name() FROM shown", "SELECT current_user()", "SELECT mine(id) FROM shown",
    "SELECT * FROM nowhere", "SELECT * FROM shown, LATERAL (SELECT * FROM `Csv`.`/etc/hostname`)",
    "WITH shown2 AS (SELECT * FROM `orc`.`/etc`) SELECT * FROM shown2",
    "SHOW TABLES", "DESCRIBE shown", "EXPLAIN SELECT 1",
]


@pytest.mark.parametrize("text", MORE_THAN_A_QUERY)
def test_what_spark_reads_as_more_than_a_query_is_refused(spark, text):
    shown = {"shown": spark.range(1)}
    spark.udf.register("mine", lambda x: x)
    with pytest.raises(UnsafeSQL):
        run_sql(spark, text, shown)
    with pytest.raises(UnsafeSQL):     # the plan alone is enough, whatever the words said
        require_read(spark, text)
    assert spark._jvm.java.lang.System.getProperty("screen.test") is None


@pytest.mark.parametrize("text", [
    "WITH a AS (SELECT id, count(*) AS n FROM shown GROUP BY id HAVING n > 0), b AS (SELECT * FROM a) SELECT a.*, b.n FROM a JOIN b USING (id)",
    "SELECT id, row_number() OVER (PARTITION BY id % 2 ORDER BY id DESC) AS r FROM `shown` WHERE id IN (SELECT id FROM shown)",
    "SELECT * FROM (SELECT id, 1 AS k FROM shown) PIVOT (sum(id) FOR k IN (1, 2))",
    "SELECT explode(sequence(0, id)) AS x FROM shown UNION ALL SELECT * FROM VALUES (1), (2) AS v(x) EXCEPT SELECT 7",
    "SELECT CASE WHEN id BETWEEN 0 AND 3 THEN upper('a') ELSE date_format(DATE '2020-01-01', 'yyyy') END AS c, cast(id AS string) FROM shown ORDER BY 1",
    "SELECT s.id, e.col FROM shown s LATERAL VIEW explode(array(1, 2)) e AS col",
    "SELECT (SELECT max(id) FROM shown t WHERE t.id = s.id), transform(array(1), x -> x + 1) FROM shown s",
    "SELECT percentile_approx(id, 0.5), max_by(id, id), `count`(DISTINCT id) FROM shown s",
    "SELECT * FROM kept.sold JOIN range(3) r ON sold.id = r.id",
    "SELECT grouping(id), sum(id) FILTER (WHERE id > 0) FROM shown GROUP BY ROLLUP (id)",
])
def test_honest_queries_run(spark, text):
    spark.sql("CREATE SCHEMA IF NOT EXISTS kept")
    if not spark.catalog.tableExists("kept.sold"):
        spark.range(3).write.saveAsTable("kept.sold")
    run_sql(spark, text, {"shown": spark.range(4)}).collect()
