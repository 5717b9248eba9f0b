"""The same questions as plain SQL over the same tables, for an independent engine to answer."""

from __future__ import annotations

import json
from pathlib import Path

from invoicelake import schema
from invoicelake.plans.pipeline import COLUMN_COMMENTS
from invoicelake.plans.registry import HOME, YEAR

# fixed values: the words a screened text may not hold, written down apart from the code that is checked
FORBIDDEN = (
    "insert", "update", "delete", "merge", "drop", "create", "alter", "truncate", "grant",
    "revoke", "copy", "call", "exec", "execute", "attach", "install", "load", "pragma", "set",
    "use", "optimize", "vacuum", "refresh", "read_csv", "read_parquet", "read_json", "read_files",
)

BRONZE = """
base AS (
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, CAST(l.l_quantity AS INTEGER) AS qty,
         l.l_returnflag = 'R' AND l.l_orderkey % 5 = 0 AS cancel,
         substr(CAST(o.o_orderdate AS VARCHAR), 1, 10) AS od, o.o_custkey AS ck,
         n.n_name AS nat, p.p_name AS pname, p.p_partkey AS pk,
         (l.l_orderkey * 7 + l.l_partkey * 3 + l.l_linenumber * 11) % 100 AS h
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey),
lines AS (
  SELECT CASE WHEN h = 0 THEN 'A' WHEN cancel THEN 'C' ELSE '' END || CAST(ok AS VARCHAR) AS invoice,
         CASE WHEN h = 1 THEN 'POST' WHEN h = 2 THEN 'm'
              WHEN pk % 7 = 0 THEN ' ' || CAST(10000 + pk AS VARCHAR) || 'a '
              ELSE CAST(10000 + pk AS VARCHAR) END AS stock_code,
         pname || ' ' AS description,
         CASE WHEN h = 3 THEN 'abc' WHEN cancel <> (h = 4) THEN CAST(-qty AS VARCHAR)
              ELSE CAST(qty AS VARCHAR) END AS quantity,
         CASE WHEN h = 7 THEN 'not a date'
              ELSE od || ' ' || lpad(CAST(8 + h % 10 AS VARCHAR), 2, '0') || ':00:00' END AS invoice_date,
         CASE WHEN h = 5 THEN '0' WHEN h = 6 THEN ''
              ELSE CAST(1 + pk % 20 AS VARCHAR) || '.' || lpad(CAST(pk % 100 AS VARCHAR), 2, '0') END AS price,
         CASE WHEN ok % 20 <> 0 THEN CAST(ck AS VARCHAR) END AS customer_id, nat AS country, h
  FROM base),
planted AS (
  SELECT o_orderkey AS ok, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS od,
         CAST(o_custkey AS VARCHAR) AS ck FROM orders WHERE o_orderkey % 1000 = 3),
bronze AS (
  SELECT * EXCLUDE (h) FROM lines
  UNION ALL SELECT * EXCLUDE (h) FROM lines WHERE h = 8
  UNION ALL SELECT mark || CAST(900000000 + ok AS VARCHAR) || suffix, '23843', 'PAPER CRAFT', units,
                   od || clock, '2.08', ck, 'NATION_0'
  FROM planted, (VALUES ('', '80000', ' 09:15:00', '', -1), ('C', '-80000', ' 09:27:00', '', -1),
                        ('C', '-80000', ' 09:28:00', 'b', 3),
                        ('', '80000', ' 10:00:00', 'n', 1003), ('C', '-80000', ' 10:17:00', 'n', 1003),
                        ('', '80000', ' 09:20:00', 's', 2003), ('C', '-80000', ' 09:30:00', 's', 2003)
                ) AS e(mark, units, clock, suffix, kind)
  WHERE kind = -1 OR ok % 4000 = kind)"""

TYPED = """
typed AS (
  SELECT DISTINCT trim(invoice) AS invoice, upper(trim(stock_code)) AS stock_code,
         trim(description) AS description, TRY_CAST(quantity AS INTEGER) AS quantity,
         TRY_CAST(invoice_date AS TIMESTAMP) AS invoice_ts, TRY_CAST(price AS DECIMAL(18,4)) AS price,
         trim(customer_id) AS customer_id, trim(country) AS country
  FROM bronze)"""

LABELLED = """
labelled AS (
  SELECT *, starts_with(invoice, 'C') AS is_cancellation,
         CASE WHEN invoice_ts IS NULL OR quantity IS NULL OR price IS NULL THEN 'unparseable'
              WHEN starts_with(invoice, 'A') THEN 'bad_debt_adjustment'
              WHEN NOT regexp_matches(stock_code, '^[0-9]{5}') THEN 'non_product_code'
              WHEN price <= 0 THEN 'zero_or_negative_price'
              WHEN starts_with(invoice, 'C') <> (quantity < 0) THEN 'stock_writeoff' END AS reject_reason
  FROM typed)"""

SILVER = """
silver AS (
  SELECT * EXCLUDE (reject_reason), CAST(invoice_ts AS DATE) AS invoice_date,
         CAST(round(quantity * price, 2) AS DECIMAL(18,2)) AS line_value
  FROM labelled WHERE reject_reason IS NULL)"""

KPIS = """
gold_monthly_kpis AS (
  SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, country,
         CAST(COALESCE(SUM(line_value) FILTER (NOT is_cancellation), 0) AS DOUBLE) AS gross_revenue,
         CAST(-COALESCE(SUM(line_value) FILTER (is_cancellation), 0) AS DOUBLE) AS cancelled_value,
         COUNT(DISTINCT invoice) FILTER (NOT is_cancellation) AS orders,
         COUNT(DISTINCT customer_id) FILTER (NOT is_cancellation) AS customers,
         CAST(COALESCE(SUM(quantity) FILTER (NOT is_cancellation), 0) AS BIGINT) AS units,
         CAST(COALESCE(SUM(line_value), 0) AS DOUBLE) AS net_revenue
  FROM silver GROUP BY ALL)"""

PRODUCTS = """
gold_product_performance AS (
  SELECT stock_code, MAX(description) AS description,
         CAST(COALESCE(SUM(quantity) FILTER (NOT is_cancellation), 0) AS BIGINT) AS units_sold,
         CAST(COALESCE(SUM(line_value) FILTER (NOT is_cancellation), 0) AS DOUBLE) AS gross_revenue,
         CAST(-COALESCE(SUM(line_value) FILTER (is_cancellation), 0) AS DOUBLE) AS cancelled_value,
         COUNT(DISTINCT invoice) FILTER (NOT is_cancellation) AS orders
  FROM silver GROUP BY stock_code)"""

DAYS = """
days AS (
  SELECT MAX(invoice_date) + 1 AS score_at, MAX(invoice_date) + 1 - 90 AS test_at,
         MAX(invoice_date) + 1 - 180 AS train_at FROM silver)"""


def features(name: str, day: str) -> str:
    return f"""
{name}_totals AS (
  SELECT customer_id, d.{day} AS as_of, MAX(country) AS country,
         MAX(invoice_date) FILTER (NOT is_cancellation) AS last_purchase,
         MIN(invoice_date) FILTER (NOT is_cancellation) AS first_purchase,
         COUNT(DISTINCT invoice) FILTER (NOT is_cancellation) AS frequency,
         CAST(SUM(line_value) AS DOUBLE) AS monetary,
         CAST(COALESCE(SUM(line_value) FILTER (invoice_date >= d.{day} - 365), 0) AS DOUBLE) AS revenue_365d,
         COUNT(DISTINCT invoice) FILTER (NOT is_cancellation AND invoice_date >= d.{day} - 90) AS orders_90d,
         COUNT(DISTINCT stock_code) FILTER (NOT is_cancellation) AS distinct_products,
         CAST(COALESCE(SUM(line_value) FILTER (NOT is_cancellation), 0) AS DOUBLE) AS gross,
         CAST(-COALESCE(SUM(line_value) FILTER (is_cancellation), 0) AS DOUBLE) AS cancelled
  FROM silver, days d WHERE customer_id IS NOT NULL AND invoice_date < d.{day}
  GROUP BY customer_id, d.{day}),
{name} AS (
  SELECT customer_id, country, last_purchase, first_purchase, frequency, monetary, revenue_365d,
         orders_90d, distinct_products,
         CASE WHEN gross <> 0 THEN floor(cancelled / gross * 10000 + 0.5) / 10000 END AS cancel_rate,
         floor(gross / frequency * 100 + 0.5) / 100 AS avg_order_value,
         CAST(as_of - last_purchase AS INTEGER) AS recency_days,
         CAST(as_of - first_purchase AS INTEGER) AS tenure_days, as_of
  FROM {name}_totals WHERE frequency > 0)"""


def returned(name: str, day: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT customer_id FROM silver, days d
  WHERE NOT is_cancellation AND customer_id IS NOT NULL
    AND invoice_date >= d.{day} AND invoice_date < d.{day} + 90)"""


def snapshot(name: str, day: str) -> str:
    return ",".join([features(f"{name}_features", day), returned(f"{name}_returned", day), f"""
{name} AS (
  SELECT f.*, CASE WHEN r.customer_id IS NULL THEN 1 ELSE 0 END AS churned
  FROM {name}_features f LEFT JOIN {name}_returned r USING (customer_id) WHERE recency_days <= 365)"""])


FEATURES = features("features", "score_at")

SCORES = """
CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score"""

RFM = f"""
scored AS (SELECT *, {SCORES} FROM features),
gold_customer_rfm AS (
  SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
                 WHEN r_score >= 4 AND f_score <= 2 THEN 'Promising'
                 WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
                 WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                 WHEN r_score <= 2 THEN 'Hibernating' ELSE 'Needs Attention' END AS segment
  FROM scored)"""

TEST = snapshot("test", "test_at")
TRAIN = snapshot("train", "train_at")

RISK = f"""
rates AS (
  SELECT r_score, CAST(SUM(churned) AS DOUBLE) / COUNT(*) AS p
  FROM (SELECT churned, {SCORES} FROM test) GROUP BY r_score),
gold_customer_churn_risk AS (
  SELECT f.*, round_even(p * 10000, 0) / 10000 AS churn_probability,
         round_even(p * greatest(revenue_365d, 0) * 100, 0) / 100 AS revenue_at_risk
  FROM gold_customer_rfm f JOIN rates USING (r_score) WHERE recency_days <= 365)"""

CALLED = """
called AS (SELECT customer_id, country, revenue_365d, churn_probability, revenue_at_risk
           FROM gold_customer_churn_risk ORDER BY revenue_at_risk DESC, customer_id LIMIT 100)"""

PAIRS = """
brackets AS (
  SELECT *, SUM(CASE WHEN is_cancellation THEN -1 ELSE 1 END) OVER (
           PARTITION BY customer_id, stock_code, abs(quantity)
           ORDER BY invoice_ts, is_cancellation, invoice, line_value ROWS UNBOUNDED PRECEDING)
         + CASE WHEN is_cancellation THEN 1 ELSE 0 END AS depth
  FROM silver WHERE customer_id IS NOT NULL AND stock_code IS NOT NULL AND is_cancellation IS NOT NULL),
closed AS (
  SELECT *, lag(is_cancellation) OVER w AS before_cancels, lag(invoice) OVER w AS before_invoice,
         lag(invoice_ts) OVER w AS before_ts, lag(line_value) OVER w AS before_value
  FROM brackets
  WINDOW w AS (PARTITION BY customer_id, stock_code, abs(quantity), depth
               ORDER BY invoice_ts, is_cancellation, invoice, line_value)),
pairs AS (
  SELECT customer_id, stock_code, abs(quantity) AS units, before_invoice AS sale_invoice,
         invoice AS cancel_invoice, before_ts AS sale_ts, invoice_ts AS cancel_ts,
         CAST(before_value AS DOUBLE) AS sale_value, CAST(-line_value AS DOUBLE) AS cancelled_value
  FROM closed
  WHERE is_cancellation AND NOT before_cancels AND invoice_ts <= before_ts + INTERVAL 16 MINUTES)"""

MEASURES = """
       CAST(SUM(CAST(gross_revenue AS DECIMAL(28,2))) AS DOUBLE) AS gross_revenue,
       CAST(SUM(CAST(cancelled_value AS DECIMAL(28,2))) AS DOUBLE) AS cancelled_value,
       CAST(SUM(CAST(net_revenue AS DECIMAL(28,2))) AS DOUBLE) AS net_revenue,
       CAST(SUM(orders) AS BIGINT) AS total_orders"""
RATIOS = """
       CASE WHEN gross_revenue <> 0 THEN cancelled_value / gross_revenue END AS leakage,
       CASE WHEN total_orders <> 0 THEN gross_revenue / total_orders END AS avg_order_value"""

CALENDAR = """
calendar AS (
  SELECT CAST(day AS DATE) AS date, CAST(year(day) AS INTEGER) AS year,
         strftime(day, '%b %Y') AS month, CAST(year(day) * 100 + month(day) AS INTEGER) AS month_no
  FROM (SELECT unnest(generate_series(MIN(month), last_day(MAX(month)), INTERVAL 1 DAY)) AS day
        FROM gold_monthly_kpis))"""
BY_MONTH = f"""
facts AS (SELECT *, {RATIOS} FROM (SELECT month AS date, {MEASURES} FROM gold_monthly_kpis GROUP BY month)),
by_month AS (
  SELECT c.date, year, c.month, month_no, gross_revenue, cancelled_value, net_revenue, leakage,
         total_orders, avg_order_value
  FROM calendar c LEFT JOIN facts USING (date) WHERE day(c.date) = 1)"""

PRODUCT_MEASURES = """
product_measures AS (
  SELECT *, CASE WHEN product_gross_revenue <> 0
                 THEN product_cancelled_value / product_gross_revenue END AS product_cancel_rate
  FROM (SELECT description,
               CAST(SUM(CAST(gross_revenue AS DECIMAL(28,2))) AS DOUBLE) AS product_gross_revenue,
               CAST(SUM(CAST(cancelled_value AS DECIMAL(28,2))) AS DOUBLE) AS product_cancelled_value
        FROM gold_product_performance GROUP BY description))"""

SCREENED = rf"""
log AS (
  SELECT 'part-' || CAST(p_partkey AS VARCHAR) AS query_id,
         CASE p_partkey % 10
           WHEN 0 THEN r WHEN 1 THEN r || ' LIMIT ' || CAST(p_partkey AS VARCHAR)
           WHEN 2 THEN '```sql' || chr(10) || r || ';' || chr(10) || '```'
           WHEN 3 THEN 'DELETE FROM gold_product_performance WHERE description = ''' || p_name || ''''
           WHEN 4 THEN r || '; DROP TABLE gold_customer_rfm' WHEN 5 THEN r || ' -- all of them'
           WHEN 6 THEN 'WITH x AS (SELECT ''drop it; it''''s -- ' || p_name
                       || ''' AS note) SELECT * FROM x limit 1' || CAST(p_partkey AS VARCHAR)
           WHEN 7 THEN 'SELECT `reflect`(''java.lang.System'', ''getProperty'', ''' || p_name || ''')'
           WHEN 8 THEN 'SELECT * FROM `TEXT`.`/landing/' || p_name || '`'
           ELSE '  ' END AS sql
  FROM (SELECT *, 'SELECT stock_code FROM gold_product_performance WHERE description LIKE ''%' || p_name || '%''' AS r
        FROM part)
  UNION ALL
  SELECT 'chat-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text FROM conversations),
bare AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(
              regexp_replace(sql, '^\s+|\s+$', '', 'g'), '^```(?:sql)?|```$', '', 'gi'),
            '^\s+|\s+$', '', 'g'), ';+$', '') AS s0 FROM log),
code AS (SELECT query_id, sql, s, regexp_replace(s, '''[^'']*''', '''''', 'g') AS code
         FROM (SELECT *, regexp_replace(s0, '^\s+|\s+$', '', 'g') AS s FROM bare)),
judged AS (
  SELECT *, CASE WHEN code = '' THEN 'empty text'
                 WHEN contains(code, ';') OR contains(code, '--') OR contains(code, '/*')
                   THEN 'several statements or a comment'
                 WHEN NOT regexp_matches(code, '(?i)^(select|with)\b') THEN 'not a SELECT'
                 WHEN regexp_matches(code, '(?i)\b({"|".join(FORBIDDEN)})\b')
                   THEN 'forbidden word: ' || lower(regexp_extract(code, '(?i)\b({"|".join(FORBIDDEN)})\b', 1))
                 WHEN starts_with(code, 'SELECT `reflect`(') THEN 'forbidden word: reflect'
                 WHEN starts_with(code, 'SELECT * FROM `TEXT`.`/') THEN 'a table named by a path'
            END AS blocked_because,
            regexp_extract(code, '(?i)\blimit\s+(\d+)\s*$', 1) AS n
  FROM code)"""

# per case, the columns of the reference and of the candidate that hold the same: (reference, candidate, a number)
CASE_COLUMNS = (
    (("country", "country", False), ("v", "monthly", True)),
    (("q", "quarter", True), ("v", "net", True)),
    (("country", "country", False),),
    (("month", "month", False), ("v", "lost", True)),
    (("country", "country", False), ("n", "champions", True)),
    (("segment", "segment", False), ("v", "loss", True)),
    (("v", "safe", True),),
    (("stock_code", "code", False), ("cancelled_value", "lost", True)),
)


def _judged_cases() -> str:
    """Every case as (question, ok, sql): column by column in sorted order, numbers within half a percent."""
    cases = json.loads((Path(__file__).parent / "eval_cases.json").read_text())

    def same(case: dict, wanted: str, found: str, number: bool) -> str:
        sides = [f"(SELECT *, row_number() OVER (ORDER BY {c} NULLS FIRST) AS i FROM ({case[k]}))"
                 for k, c in (("sql", wanted), ("candidate", found))]
        w, g = f"w.{wanted}", f"g.{found}"
        equal = (f"abs(round_even(CAST({g} AS DOUBLE), 2) - round_even(CAST({w} AS DOUBLE), 2)) "
                 f"<= 1e-8 + 0.005 * abs(round_even(CAST({w} AS DOUBLE), 2))" if number else f"{g} = {w}")
        return f"(SELECT bool_and(coalesce({equal}, {g} IS NULL AND {w} IS NULL)) FROM {sides[0]} w FULL JOIN {sides[1]} g USING (i))"

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    return " UNION ALL ".join(
        f"SELECT {text(case['question'])} AS question, {' AND '.join(same(case, *c) for c in columns)} AS ok, "
        f"{text(case['candidate'])} AS sql" for case, columns in zip(cases, CASE_COLUMNS, strict=True))


MATCHES = """
reference AS (
  SELECT country, CAST(SUM(CAST(gross_revenue AS DECIMAL(28,2))) AS DOUBLE) AS gross
  FROM gold_monthly_kpis GROUP BY country),
result AS (
  SELECT country AS nation, COUNT(*) AS lines,
         1.001 * CAST(SUM(line_value) FILTER (NOT is_cancellation) AS DOUBLE) AS total
  FROM silver GROUP BY country),
wanted AS (SELECT gross, row_number() OVER (ORDER BY gross NULLS FIRST) AS i FROM reference),
totals AS (SELECT total, row_number() OVER (ORDER BY total NULLS FIRST) AS i FROM result),
counts AS (SELECT lines, row_number() OVER (ORDER BY lines) AS i FROM result),
compared AS (
  SELECT (SELECT COUNT(*) FROM reference) = (SELECT COUNT(*) FROM result) AS same_rows,
         bool_and(abs(total - gross) <= 1e-8 + 0.005 * abs(gross)) AS by_total,
         bool_and(abs(lines - gross) <= 1e-8 + 0.005 * abs(gross)) AS by_lines
  FROM wanted LEFT JOIN totals USING (i) LEFT JOIN counts USING (i)),
found AS (
  SELECT 'country' AS reference_column,
         CASE WHEN same_rows AND NOT EXISTS (SELECT country FROM reference EXCEPT ALL SELECT nation FROM result)
              THEN 'Nation' END AS matched_by FROM compared
  UNION ALL
  SELECT 'gross_revenue', CASE WHEN same_rows AND by_lines THEN 'lines' WHEN same_rows AND by_total THEN 'total' END
  FROM compared)"""

TO_SILVER = [BRONZE, TYPED, LABELLED, SILVER]
ALL_GOLD = [*TO_SILVER, KPIS, PRODUCTS, DAYS, FEATURES, RFM]
ON_RISK = [*TO_SILVER, DAYS, FEATURES, RFM, TEST, RISK]


def _sql(parts: list[str], body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def _typed(columns: str) -> str:
    """Money columns as published."""
    return columns.replace("price", "CAST(price AS DOUBLE) AS price").replace(
        "line_value", "CAST(line_value AS DOUBLE) AS line_value")


LINE = "invoice, stock_code, description, quantity, invoice_ts, price, customer_id, country"


def all_oracles() -> dict[str, str]:
    lab, kpi = TO_SILVER[:3], [*TO_SILVER, KPIS]
    clean = "COUNT(*) FILTER (reject_reason IS NULL)"
    sqls = {
        "bronze_scan": _sql([BRONZE], "SELECT * FROM bronze"),
        "bronze_provenance": _sql([BRONZE], "SELECT *, TRUE AS from_landing, TRUE AS has_time FROM bronze"),
        "bronze_union": _sql([BRONZE], "SELECT * REPLACE (NULLIF(price, '') AS price) FROM bronze"),
        "dedupe_lines": _sql(lab[:2], f"SELECT {_typed(LINE)} FROM typed"),
        "label_rows": _sql(lab, f"SELECT {_typed(LINE)}, is_cancellation, reject_reason FROM labelled"),
        "silver": _sql(TO_SILVER, f"SELECT {_typed(LINE + ', is_cancellation, invoice_date, line_value')} FROM silver"),
        "quarantine": _sql(lab, f"SELECT {_typed(LINE)}, is_cancellation, reject_reason FROM labelled WHERE reject_reason IS NOT NULL"),
        "reject_report": _sql(lab, "SELECT reject_reason, COUNT(*) AS lines FROM labelled GROUP BY reject_reason"),
        "retention": _sql(lab, f"SELECT COUNT(*) AS total, {clean} AS kept, {clean} / COUNT(*) AS retention FROM labelled"),
        "quality_gate": _sql(lab, f"SELECT COUNT(*) AS total, {clean} AS kept, {clean} / COUNT(*) AS retention, {clean} / COUNT(*) >= 0.9 AS passed FROM labelled"),
        "split_reconcile": _sql(TO_SILVER, """
            SELECT *, labelled = silver + quarantine AS balanced FROM (
              SELECT (SELECT COUNT(*) FROM labelled) AS labelled, (SELECT COUNT(*) FROM silver) AS silver,
                     (SELECT COUNT(*) FROM labelled WHERE reject_reason IS NOT NULL) AS quarantine)"""),
        "monthly_kpis": _sql(kpi, "SELECT * FROM gold_monthly_kpis"),
        "product_performance": _sql([*TO_SILVER, PRODUCTS], "SELECT * FROM gold_product_performance"),
        "snapshot_dates": _sql([*TO_SILVER, DAYS], "SELECT * FROM days"),
        "customer_features": _sql([*TO_SILVER, DAYS, FEATURES], "SELECT * FROM features"),
        "active_customers": _sql([*TO_SILVER, DAYS, FEATURES], "SELECT * FROM features WHERE recency_days <= 365"),
        "returned_customers": _sql([*TO_SILVER, DAYS, returned("back", "test_at")], "SELECT * FROM back"),
        "churn_snapshot": _sql([*TO_SILVER, DAYS, TEST], "SELECT * FROM test"),
        "churned_anti": _sql([*TO_SILVER, DAYS, TEST], "SELECT * EXCLUDE (churned) FROM test WHERE churned = 1"),
        "retained_semi": _sql([*TO_SILVER, DAYS, TEST], "SELECT * EXCLUDE (churned) FROM test WHERE churned = 0"),
        "oot_snapshots": _sql([*TO_SILVER, DAYS, TEST, TRAIN],
                              "SELECT *, 'train' AS split FROM train UNION ALL SELECT *, 'test' AS split FROM test"),
        "rfm_scores": _sql([*TO_SILVER, DAYS, FEATURES, RFM], "SELECT customer_id, r_score, f_score, m_score FROM scored"),
        "rfm_segments": _sql([*TO_SILVER, DAYS, FEATURES, RFM], "SELECT * FROM gold_customer_rfm"),
        "segment_rollup": _sql([*TO_SILVER, DAYS, FEATURES, RFM], """
            SELECT segment, COUNT(*) AS customers,
                   CAST(round(SUM(CAST(revenue_365d AS DECIMAL(28,2))), 0) AS DOUBLE) AS revenue_365d
            FROM gold_customer_rfm GROUP BY segment"""),
        "churn_base_rate": _sql([*TO_SILVER, DAYS, TEST], "SELECT COUNT(*) AS customers, AVG(churned) AS churn_base_rate FROM test"),
        # rank sum over all pairs' order: average rank of the churned among all
        "scoring_check": _sql([*TO_SILVER, DAYS, FEATURES], """
            SELECT COUNT(*) AS customers, CAST(0 AS BIGINT) AS apart FROM features WHERE recency_days <= 365"""),
        "recency_auc": _sql([*TO_SILVER, DAYS, TEST], """
            SELECT floor((SUM(r) FILTER (churned = 1) - pos * (pos + 1) / 2) / (pos * neg) * 10000 + 0.5) / 10000
                     AS baseline_recency_auc, ANY_VALUE(n) AS customers
            FROM (SELECT churned, COUNT(*) OVER () AS n,
                         CAST(SUM(churned) OVER () AS DOUBLE) AS pos,
                         CAST(SUM(1 - churned) OVER () AS DOUBLE) AS neg,
                         rank() OVER (ORDER BY recency_days)
                           + (COUNT(*) OVER (PARTITION BY recency_days) - 1) / 2 AS r FROM test)
            GROUP BY pos, neg"""),
        "top_decile": _sql([*TO_SILVER, DAYS, TEST], """
            SELECT COUNT(*) AS customers, CAST(SUM(churned) AS BIGINT) AS churned, AVG(churned) AS precision
            FROM (SELECT churned, row_number() OVER (ORDER BY recency_days DESC, customer_id) AS r,
                         COUNT(*) OVER () AS n FROM test) WHERE r <= greatest(1, n // 10)"""),
        "risk_by_rate": _sql(ON_RISK, "SELECT * FROM gold_customer_churn_risk"),
        "calendar": _sql([*kpi, CALENDAR], "SELECT * FROM calendar"),
        "calendar_kpis": _sql([*kpi, CALENDAR, BY_MONTH], "SELECT * FROM by_month"),
        "bi_overview": _sql(kpi, f"SELECT *, {RATIOS} FROM (SELECT {MEASURES} FROM gold_monthly_kpis)"),
        "bi_leakage_by_month": _sql([*kpi, CALENDAR, BY_MONTH], "SELECT date, month, month_no, leakage FROM by_month"),
        "bi_yoy": _sql([*kpi, CALENDAR, BY_MONTH], """
            SELECT m.date, m.month_no, m.net_revenue, p.net_revenue AS prior_net_revenue,
                   CASE WHEN p.net_revenue <> 0
                        THEN (COALESCE(m.net_revenue, 0) - p.net_revenue) / p.net_revenue END AS yoy
            FROM by_month m LEFT JOIN by_month p ON m.month_no = p.month_no + 100"""),
        "bi_year_slice": _sql(kpi, f"""
            SELECT *, {RATIOS} FROM (SELECT {MEASURES} FROM gold_monthly_kpis WHERE year(month) = {YEAR})"""),
        "bi_top_countries": _sql(kpi, f"""
            SELECT country, net_revenue FROM (SELECT country, {MEASURES} FROM gold_monthly_kpis GROUP BY country)
            ORDER BY net_revenue DESC, country LIMIT 10"""),
        "bi_top_cancelled": _sql([*TO_SILVER, PRODUCTS, PRODUCT_MEASURES], """
            SELECT description, product_cancelled_value FROM product_measures
            ORDER BY product_cancelled_value DESC, description LIMIT 10"""),
        "bi_cancel_rate_table": _sql([*TO_SILVER, PRODUCTS, PRODUCT_MEASURES],
                                     "SELECT * FROM product_measures WHERE product_gross_revenue > 1000"),
        "bi_segment_counts": _sql([*TO_SILVER, DAYS, FEATURES, RFM],
                                  "SELECT segment, COUNT(*) AS customers FROM gold_customer_rfm GROUP BY segment"),
        "product_like": _sql([*TO_SILVER, PRODUCTS], "SELECT * FROM gold_product_performance WHERE description LIKE '%widget%'"),
        "reversal_pairs": _sql([*TO_SILVER, PAIRS], "SELECT * FROM pairs"),
        "reversal_share": _sql([*kpi, PAIRS], """
            SELECT *, flagged_value / cancelled_value AS share FROM (
              SELECT (SELECT COUNT(*) FROM pairs) AS pairs,
                     (SELECT CAST(COALESCE(SUM(CAST(cancelled_value AS DECIMAL(28,2))), 0) AS DOUBLE) FROM pairs) AS flagged_value,
                     (SELECT CAST(SUM(CAST(cancelled_value AS DECIMAL(28,2))) AS DOUBLE) FROM gold_monthly_kpis) AS cancelled_value)"""),
        # the definition read literally: drop the flagged lines from silver, then add up
        "leakage_adjusted": _sql([*TO_SILVER, PAIRS], """
            SELECT CAST(year(invoice_date) AS INTEGER) AS year,
                   CAST(-SUM(line_value) FILTER (is_cancellation) AS DOUBLE)
                     / CAST(SUM(line_value) FILTER (NOT is_cancellation) AS DOUBLE) AS leakage_reported,
                   CAST(COALESCE(-SUM(line_value) FILTER (is_cancellation AND NOT flagged), 0) AS DOUBLE)
                     / CAST(SUM(line_value) FILTER (NOT is_cancellation AND NOT flagged) AS DOUBLE) AS leakage_adjusted
            FROM (SELECT *, EXISTS (
                    SELECT 1 FROM pairs p WHERE p.customer_id = s.customer_id AND p.stock_code = s.stock_code
                      AND p.units = abs(s.quantity)
                      AND CASE WHEN is_cancellation THEN p.cancel_invoice = s.invoice AND p.cancel_ts = s.invoice_ts
                               ELSE p.sale_invoice = s.invoice AND p.sale_ts = s.invoice_ts END) AS flagged
                  FROM silver s)
            GROUP BY year"""),
        "order_entry_check": _sql(TO_SILVER, f"""
            SELECT {_typed(LINE + ', is_cancellation, invoice_date, line_value')} FROM silver
            WHERE NOT is_cancellation AND (quantity > 5000 OR line_value > 10000)"""),
        "segment_share": _sql([*TO_SILVER, DAYS, FEATURES, RFM], """
            SELECT segment, customers, CAST(total AS DOUBLE) AS revenue_365d,
                   CAST(total AS DOUBLE) / CAST(SUM(total) OVER () AS DOUBLE) AS share
            FROM (SELECT segment, COUNT(*) AS customers, SUM(CAST(revenue_365d AS DECIMAL(28,2))) AS total
                  FROM gold_customer_rfm GROUP BY segment)"""),
        "screen_queries": _sql([SCREENED], r"""
            SELECT query_id, sql, blocked_because,
                   CASE WHEN blocked_because IS NOT NULL THEN NULL
                        WHEN n = '' THEN s || chr(10) || 'LIMIT 200'
                        WHEN CAST(n AS BIGINT) <= 200 THEN s
                        ELSE regexp_replace(s, '(?i)\blimit\s+(\d+)\s*$', 'LIMIT 200') END AS safe_sql
            FROM judged"""),
    }
    risk_sum = "CAST(SUM(CAST(revenue_at_risk AS DECIMAL(28,2))) AS DOUBLE)"
    sqls |= {
        "bi_risk_cards_by_rate": _sql(ON_RISK, f"""
            SELECT COUNT(*) AS active_customers, {risk_sum} AS revenue_at_risk,
                   COUNT(*) FILTER (churn_probability >= 0.5) AS high_risk_customers,
                   COALESCE(CAST(SUM(CAST(revenue_at_risk AS DECIMAL(28,2))) FILTER (churn_probability >= 0.5) AS DOUBLE), 0)
                     AS high_risk_revenue
            FROM gold_customer_churn_risk"""),
        "bi_scatter_by_rate": _sql(ON_RISK, "SELECT customer_id, recency_days, revenue_365d, churn_probability FROM gold_customer_churn_risk"),
        "call_list_by_rate": _sql([*ON_RISK, CALLED], "SELECT * FROM called"),
        "risk_concentration_by_rate": _sql([*ON_RISK, CALLED], f"""
            SELECT *, top_customers / customers AS customer_share, top_revenue_at_risk / revenue_at_risk AS risk_share
            FROM (SELECT COUNT(*) AS customers, {risk_sum} AS revenue_at_risk FROM gold_customer_churn_risk),
                 (SELECT COUNT(*) AS top_customers, {risk_sum} AS top_revenue_at_risk FROM called)"""),
        "winback_list_by_rate": _sql([*ON_RISK, CALLED], """
            SELECT customer_id, country, revenue_365d, churn_probability, revenue_at_risk
            FROM gold_customer_churn_risk
            WHERE churn_probability >= 0.5 AND customer_id NOT IN (SELECT customer_id FROM called)"""),
        "retention_scenarios_by_rate": _sql([*ON_RISK, CALLED], f"""
            SELECT s.retained_share, call_list_risk, call_list_risk * s.retained_share AS retained_revenue
            FROM (SELECT {risk_sum} AS call_list_risk FROM called),
                 (SELECT unnest([0.1::DOUBLE, 0.2::DOUBLE, 0.3::DOUBLE]) AS retained_share) s"""),
        "call_routing_by_rate": _sql([*ON_RISK, CALLED], """
            SELECT customer_id, segment, c.revenue_at_risk,
                   CASE WHEN segment = 'Champions' THEN 'senior account manager' ELSE 'account manager' END AS caller
            FROM called c JOIN gold_customer_rfm USING (customer_id)"""),
        "risk_share_by_rate": _sql(ON_RISK, f"""
            SELECT *, revenue_at_risk / revenue_365d AS share FROM (
              SELECT COUNT(*) AS customers, {risk_sum} AS revenue_at_risk,
                     CAST(SUM(CAST(revenue_365d AS DECIMAL(28,2))) AS DOUBLE) AS revenue_365d
              FROM gold_customer_churn_risk)"""),
    }
    sqls["result_match"] = _sql(
        [*kpi, MATCHES], "SELECT reference_column, matched_by, matched_by IS NOT NULL AS matched FROM found")

    sqls["parquet_sink"] = sqls["monthly_kpis"]
    sqls["gold_views"] = _sql([*ALL_GOLD, TEST, RISK], """
        SELECT 'gold_monthly_kpis' AS table_name, COUNT(*) AS table_rows FROM gold_monthly_kpis
        UNION ALL SELECT 'gold_product_performance', COUNT(*) FROM gold_product_performance
        UNION ALL SELECT 'gold_customer_rfm', COUNT(*) FROM gold_customer_rfm
        UNION ALL SELECT 'gold_customer_churn_risk', COUNT(*) FROM gold_customer_churn_risk""")

    sqls["eval_cases"] = _sql([*ALL_GOLD, TEST, RISK], _judged_cases())
    sqls["eval_accuracy"] = _sql([*ALL_GOLD, TEST, RISK], f"""
        SELECT COUNT(*) AS cases, COUNT(*) FILTER (ok) AS passed, AVG(CASE WHEN ok THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
        FROM ({_judged_cases()})""")
    sqls["data_dictionary"] = _sql(ALL_GOLD, " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, unnest(columns, recursive := true) FROM (SELECT ["
        + ", ".join("{'column_name': '%s', 'comment': '%s', 'filled': COUNT(%s)}" % (
            c, COLUMN_COMMENTS[c].replace("'", "''"), c) for c in columns) + f"] AS columns FROM {source})"
        for table, source, columns in (
            ("silver_transactions", "silver", schema.SILVER.names),
            ("gold_monthly_kpis", "gold_monthly_kpis", schema.MONTHLY_KPIS.names),
            ("gold_product_performance", "gold_product_performance", schema.PRODUCT_PERFORMANCE.names),
            ("gold_customer_rfm", "gold_customer_rfm", schema.CUSTOMER_RFM.names))))
    sqls["landing_status"] = _sql([BRONZE], """
        SELECT 'loaded' AS status, COUNT(*) AS landed_rows, COUNT(*) AS bronze_rows FROM bronze WHERE length(invoice) % 2 = 0
        UNION ALL SELECT 'missing', COUNT(*), 0 FROM bronze WHERE length(invoice) % 2 = 1""")
    sqls["extract_lines"] = """
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice,
               CASE WHEN o_orderkey % 3 = 0 THEN 'two' || chr(10) || 'lines, "quoted"' WHEN o_orderkey % 3 = 1 THEN 'plain' END AS description,
               CAST(NULL AS VARCHAR) AS damaged
        FROM orders WHERE o_orderkey % 5 <> 0
        UNION ALL SELECT NULL, NULL, CAST(o_orderkey AS VARCHAR) || ',cut short' FROM orders WHERE o_orderkey % 5 = 0"""

    def added(column: str) -> str:
        return f"CAST(SUM(CAST({column} AS DECIMAL(28,2))) AS DOUBLE) AS {column}"

    in_year = f"month >= DATE '{YEAR}-01-01' AND month < DATE '{YEAR + 1}-01-01'"
    sqls |= {f"q_{name}": _sql(ALL_GOLD, body) for name, body in {
        "net_revenue_year": f"SELECT {added('net_revenue')} FROM gold_monthly_kpis WHERE {in_year}",
        "top_foreign": f"""
            SELECT country, {added('gross_revenue')} FROM gold_monthly_kpis WHERE country <> '{HOME}'
            GROUP BY country ORDER BY gross_revenue DESC, country LIMIT 5""",
        "leakage_pct": f"""
            SELECT floor(cancelled_value / gross_revenue * 100 * 100 + 0.5) / 100 AS leakage_pct
            FROM (SELECT {added('cancelled_value')}, {added('gross_revenue')} FROM gold_monthly_kpis)""",
        "best_month": f"""
            SELECT month, {added('net_revenue')} FROM gold_monthly_kpis
            GROUP BY month ORDER BY net_revenue DESC, month LIMIT 1""",
        "segment_counts": "SELECT segment, COUNT(*) AS customers FROM gold_customer_rfm GROUP BY segment",
        "top_cancelled": """
            SELECT stock_code, description, cancelled_value FROM gold_product_performance
            ORDER BY cancelled_value DESC, stock_code LIMIT 5""",
        "at_risk_country": """
            SELECT country, COUNT(*) AS customers FROM gold_customer_rfm WHERE segment = 'At Risk'
            GROUP BY country ORDER BY customers DESC, country LIMIT 1""",
        "monthly_net": f"""
            SELECT month, {added('net_revenue')} FROM gold_monthly_kpis WHERE {in_year} GROUP BY month""",
    }.items()}
    sqls |= {f"q_{name}_by_rate": _sql(ON_RISK, body) for name, body in {
        "total_risk": f"SELECT {added('revenue_at_risk')} FROM gold_customer_churn_risk",
        "top_risk": """
            SELECT customer_id, revenue_at_risk FROM gold_customer_churn_risk
            ORDER BY revenue_at_risk DESC, customer_id LIMIT 10""",
        "high_risk": "SELECT COUNT(*) AS customers FROM gold_customer_churn_risk WHERE churn_probability > 0.5",
    }.items()}
    return sqls
