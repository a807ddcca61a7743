"""The same results as SQL for another engine. Written from the meaning of each
operator, not from the Spark code: exact integer arithmetic stands in for
decimal means, and no file is written or read."""

from __future__ import annotations

FACT = """
fact AS (
  SELECT l_orderkey, l_linenumber,
         CAST(p_partkey AS INTEGER) AS product_id,
         p_name AS product_name,
         p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(l_quantity AS INTEGER) AS quantity_sold,
         CAST(l_shipdate AS DATE) AS sale_date,
         CAST(o_custkey AS INTEGER) AS customer_id,
         r_name AS region
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""


def mean_cents(column: str) -> str:
    """Exact half-up mean of non-negative cents."""
    cents = f"CAST({column} * 100 AS HUGEINT)"
    return (
        f"CAST(CAST((2 * sum({cents}) + count({column})) // (2 * count({column})) "
        f"AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"
    )


def daily_from(source: str) -> str:
    return f"""
  SELECT category, region, sale_date,
         CAST(sum(quantity_sold) AS BIGINT) AS total_quantity,
         CAST(sum(price * quantity_sold) AS DECIMAL(38,2)) AS total_revenue,
         count(product_id) AS product_count,
         {mean_cents("price")} AS avg_price,
         '2024-02-01 06:30:00' AS last_processed
  FROM {source}
  GROUP BY category, region, sale_date
"""


DAILY = f"{FACT}, daily AS ({daily_from('fact')})"

TEXT_RECORD = """
  SELECT category, region,
         CAST(sale_date AS VARCHAR) AS sale_date,
         CAST(total_quantity AS VARCHAR) AS total_quantity,
         CAST(total_revenue AS VARCHAR) AS total_revenue,
         CAST(product_count AS VARCHAR) AS product_count,
         CAST(avg_price AS VARCHAR) AS avg_price,
         last_processed
  FROM {source}
"""

RECORD = f"{DAILY}, record AS ({TEXT_RECORD.format(source='daily')})"

TARGET_COLUMNS = """
  category, region, sale_date,
  CAST(total_quantity AS INTEGER) AS total_quantity,
  CAST(total_revenue AS DECIMAL(18,2)) AS total_revenue,
  CAST(product_count AS INTEGER) AS product_count,
  avg_price, last_processed
"""

RECORD_FIELDS = (
    "category",
    "region",
    "sale_date",
    "total_quantity",
    "total_revenue",
    "product_count",
    "avg_price",
    "last_processed",
)
LINE = " || '|' || ".join(RECORD_FIELDS)
SHORT_LINE = " || '|' || ".join(RECORD_FIELDS[:-1])

FAULTY = f"""{RECORD}, faulty AS (
  SELECT day(d) AS dom, d,
         CASE day(d) WHEN 9 THEN NULL WHEN 12 THEN repeat(category, 20) ELSE category END AS category,
         region,
         CASE day(d) WHEN 3 THEN '2024-13-40' WHEN 4 THEN '2024-1-5' ELSE sale_date END AS sale_date,
         CASE day(d) WHEN 5 THEN 'x12' WHEN 6 THEN '99999999999' ELSE total_quantity END AS total_quantity,
         CASE day(d) WHEN 10 THEN '-' || total_revenue ELSE total_revenue END AS total_revenue,
         CASE day(d) WHEN 11 THEN '0' ELSE product_count END AS product_count,
         CASE day(d) WHEN 7 THEN 'abc' ELSE avg_price END AS avg_price,
         CASE day(d) WHEN 8 THEN 'yesterday' ELSE last_processed END AS last_processed
  FROM (SELECT *, CAST(sale_date AS DATE) AS d FROM record)
), typed AS (
  SELECT dom, category, region,
         CASE WHEN regexp_full_match(sale_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
              THEN TRY_CAST(sale_date AS DATE) END AS sale_date,
         TRY_CAST(total_quantity AS INTEGER) AS total_quantity,
         TRY_CAST(total_revenue AS DECIMAL(18,2)) AS total_revenue,
         TRY_CAST(product_count AS INTEGER) AS product_count,
         TRY_CAST(avg_price AS DECIMAL(18,2)) AS avg_price,
         strftime(TRY_CAST(last_processed AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS last_processed,
         concat_ws(',',
           CASE WHEN dom IN (3, 4) THEN 'unreadable:sale_date' END,
           CASE WHEN dom IN (5, 6) THEN 'unreadable:total_quantity' END,
           CASE WHEN dom = 7 THEN 'unreadable:avg_price' END,
           CASE WHEN dom = 8 THEN 'unreadable:last_processed' END,
           CASE WHEN category IS NULL THEN 'null:category' END,
           CASE WHEN length(category) > 50 THEN 'too_long:category' END,
           CASE WHEN TRY_CAST(total_revenue AS DECIMAL(18,2)) < 0 THEN 'negative:total_revenue' END,
           CASE WHEN TRY_CAST(product_count AS INTEGER) <= 0 THEN 'not_positive:product_count' END
         ) AS reasons
  FROM faulty
)"""

FAULTY_FIELDS = [f"coalesce({name}, 'NULL')" for name in RECORD_FIELDS]
FAULTY_LINES = f"""{FAULTY}, faulty_lines AS (
  SELECT dom, region, d,
         CASE dom WHEN 13 THEN {" || '|' || ".join(FAULTY_FIELDS[:-1])}
                  WHEN 14 THEN {" || '|' || ".join(FAULTY_FIELDS)} || '|extra'
                  ELSE {" || '|' || ".join(FAULTY_FIELDS)} END AS line
  FROM faulty
)"""

PRIME = 2147483647


def expanded(num_days: int) -> str:
    def mixed(x: str) -> str:
        return f"(({x}) * 48271 + 1) % {PRIME}"

    return f"""{FACT}, days AS (
  SELECT *, (CAST(product_id AS BIGINT) * 7919 + CAST(customer_id AS BIGINT) * 104729
             + CAST(new_date - DATE '1970-01-01' AS BIGINT) * 1299709) % {PRIME} AS k0
  FROM fact, (SELECT CAST(unnest(generate_series(DATE '2024-01-01',
                DATE '2024-01-01' + {num_days - 1}, INTERVAL 1 DAY)) AS DATE) AS new_date)
), d1 AS (SELECT *, {mixed("k0")} AS dq FROM days
), d2 AS (SELECT *, {mixed("dq")} AS dp FROM d1
), d3 AS (SELECT *, {mixed("dp")} AS dc FROM d2
), expanded AS (
  SELECT product_id, product_name, category,
         CAST(round(price * CAST(CAST(9000 + dp % 2001 AS DECIMAL(5,0)) * 0.0001 AS DECIMAL(5,4)), 2)
              AS DECIMAL(18,2)) AS price,
         CAST(greatest(1, quantity_sold + dq % 31 - 10) AS INTEGER) AS quantity_sold,
         new_date AS sale_date,
         CAST(customer_id + dc % 1001 AS INTEGER) AS customer_id,
         region
  FROM d3
)"""


def metrics_of(table: str) -> str:
    return f"""
SELECT 'Total Records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM {table}
UNION ALL SELECT 'Date Range', CAST(min(sale_date) AS VARCHAR) || ' to ' || CAST(max(sale_date) AS VARCHAR) FROM {table}
UNION ALL SELECT 'Categories', CAST(count(DISTINCT category) AS VARCHAR) FROM {table}
UNION ALL SELECT 'Regions', CAST(count(DISTINCT region) AS VARCHAR) FROM {table}
"""


EARLIER = f"""{DAILY}, earlier AS (
  SELECT lower(category) || ' ' AS category, * EXCLUDE (category)
  FROM daily WHERE sale_date < DATE '2001-01-01'
)"""
NORMAL = "(lower(rtrim(category)), lower(rtrim(region)), sale_date)"

AWKWARD = f"""WITH {RECORD}
SELECT category || ', a|b "c" \\' AS category, * EXCLUDE (category) FROM record"""

ROWS = "l_orderkey, l_linenumber"

MIXED = f"""{DAILY}, mixed AS (
  SELECT * REPLACE (
    CASE WHEN day(sale_date) % 2 = 1 THEN lower(category) || ' ' ELSE category END AS category,
    CASE WHEN day(sale_date) % 2 = 1 THEN lower(region) || ' ' ELSE region END AS region)
  FROM daily)"""

REASONS = """CASE dom
         WHEN 3 THEN 'unreadable:sale_date' WHEN 4 THEN 'unreadable:sale_date'
         WHEN 5 THEN 'unreadable:total_quantity' WHEN 6 THEN 'unreadable:total_quantity'
         WHEN 7 THEN 'unreadable:avg_price' WHEN 8 THEN 'unreadable:last_processed'
         WHEN 9 THEN 'null:category' WHEN 10 THEN 'negative:total_revenue'
         WHEN 11 THEN 'not_positive:product_count' WHEN 12 THEN 'too_long:category'
         ELSE 'field_count' END AS reasons"""

SQL: dict[str, str] = {
    "scan_typed_csv": f"""WITH {FACT}
SELECT product_id, product_name, category, price, quantity_sold, sale_date, customer_id, region
FROM fact WHERE day(sale_date) NOT IN (13, 14)""",
    "scan_malformed_rows": f"""WITH {FACT}
SELECT concat_ws(',',
         CASE WHEN day(sale_date) = 13 THEN 'x' ELSE '' END || CAST(product_id AS VARCHAR),
         product_name, category, CAST(price AS VARCHAR), CAST(quantity_sold AS VARCHAR),
         CASE WHEN day(sale_date) = 14 THEN '2024-13-40' ELSE CAST(sale_date AS VARCHAR) END,
         CAST(customer_id AS VARCHAR), region) AS raw,
       CASE WHEN day(sale_date) = 13 THEN 'product_id' ELSE 'sale_date' END AS reasons
FROM fact WHERE day(sale_date) IN (13, 14)""",
    "scan_quoted_records": f"""WITH {FACT}
SELECT product_id, CASE day(sale_date)
         WHEN 5 THEN product_name || chr(10) || '"q", x' || chr(10) || chr(10)
         WHEN 6 THEN '"' || chr(10) || '"' || product_name
         WHEN 7 THEN product_name || '"' ELSE product_name END AS product_name,
       category, price, quantity_sold, sale_date, customer_id, region
FROM fact""",
    "numbered_lines": f"""WITH {RECORD}
SELECT row_number() OVER (ORDER BY region, category, sale_date) AS batch_line_no, {LINE} AS line FROM record""",
    "tail_by_line": f"""WITH {RECORD}, numbered AS (
  SELECT row_number() OVER (ORDER BY region, category, sale_date) AS line_no, {LINE} AS line FROM record)
SELECT line_no, line FROM numbered WHERE line_no > (SELECT count(*) FROM numbered) - 25""",
    "scan_by_format_file": f"WITH {RECORD} SELECT * FROM record",
    "scan_latest_batch": f"""WITH {RECORD}
SELECT * REPLACE ('2024-02-02 06:30:00' AS last_processed) FROM record""",
    "scan_delimited": f"WITH {DAILY} SELECT {TARGET_COLUMNS} FROM daily",
    "scan_header_aware": f"""WITH {RECORD},
joined AS (SELECT {LINE.replace("'|'", "','")} AS line FROM record)
SELECT 'headed' AS kind, line FROM joined UNION ALL SELECT 'plain', line FROM joined""",
    "parse_sale_date": f"""WITH {FACT}, written AS (
  SELECT {ROWS}, CASE day(sale_date) WHEN 3 THEN '2024-13-40'
           WHEN 4 THEN strftime(sale_date, '%Y-%-m-%-d') ELSE CAST(sale_date AS VARCHAR) END AS date_text
  FROM fact), parsed AS (
  SELECT *, CASE WHEN regexp_full_match(date_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
                 THEN TRY_CAST(date_text AS DATE) END AS sale_date FROM written)
SELECT {ROWS}, date_text, sale_date, sale_date IS NULL AS is_rejected FROM parsed""",
    "line_revenue": f"""WITH {FACT}
SELECT {ROWS}, product_id, price, quantity_sold,
       CAST(price * quantity_sold AS DECIMAL(29,2)) AS revenue FROM fact""",
    "conform_types": f"""WITH {DAILY}
SELECT category, region, sale_date,
       TRY_CAST(total_quantity * 30000000 AS INTEGER) AS total_quantity,
       CAST(total_revenue AS DECIMAL(18,2)) AS total_revenue,
       CAST(product_count AS INTEGER) AS product_count, avg_price,
       CASE WHEN total_quantity * 30000000 > 2147483647 THEN 'out_of_range:total_quantity' ELSE '' END AS reasons
FROM daily""",
    "round_money": f"""WITH {FACT}
SELECT {ROWS}, product_id,
       CAST(CAST((CAST(price * quantity_sold * 100 AS HUGEINT) * 375 + 5000) // 10000 AS DECIMAL(18,0)) * 0.01
            AS DECIMAL(18,2)) AS amount
FROM fact""",
    "format_dates": f"""
SELECT {ROWS}, strftime(l_shipdate, '%Y-%m-%d') AS day_text,
       strftime(l_shipdate + to_hours(l_linenumber) + to_seconds(CAST(l_quantity AS BIGINT)),
                '%Y-%m-%d %H:%M:%S') AS time_text
FROM lineitem""",
    "null_sentinel": f"""WITH {RECORD}
SELECT coalesce(nullif(category, 'SMALL'), 'NULL') AS category, region, sale_date,
       CASE WHEN CAST(total_quantity AS BIGINT) >= 30 THEN total_quantity ELSE 'NULL' END AS total_quantity,
       CASE WHEN CAST(total_revenue AS DECIMAL(38,2)) >= 50000 THEN total_revenue ELSE 'NULL' END AS total_revenue,
       product_count,
       CASE WHEN CAST(avg_price AS DECIMAL(18,2)) >= 1000 THEN avg_price ELSE 'NULL' END AS avg_price,
       last_processed
FROM record""",
    "fill_defaults": f"""WITH {FACT}
SELECT {ROWS},
       coalesce(CASE WHEN l_linenumber <> 1 THEN product_id END, 1) AS product_id,
       coalesce(CASE WHEN l_linenumber <> 2 THEN product_name END, 'Unknown Product') AS product_name,
       coalesce(CASE WHEN l_linenumber <> 3 THEN category END, 'General') AS category,
       CAST(coalesce(CASE WHEN l_linenumber <> 4 THEN price END, 0) AS DECIMAL(18,2)) AS price,
       coalesce(CASE WHEN l_linenumber <> 5 THEN quantity_sold END, 1) AS quantity_sold,
       sale_date,
       coalesce(CASE WHEN l_linenumber <> 6 THEN customer_id END, 1000) AS customer_id,
       coalesce(CASE WHEN l_linenumber <> 7 THEN region END, 'Unknown') AS region
FROM fact""",
    "redelimit": AWKWARD,
    "strip_nul": f"""WITH {FACT}
SELECT CAST(product_id AS VARCHAR) || '|' || product_name || '|' || region AS line, true AS had_nul FROM fact""",
    "expand_days": f"WITH {expanded(7)} SELECT * FROM expanded",
    "daily_sales": f"WITH {DAILY} SELECT * FROM daily",
    "sales_summary": f"""WITH {DAILY}
SELECT category, region, count(*) AS days_count,
       CAST(sum(total_quantity) AS BIGINT) AS total_quantity_all_days,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_revenue_all_days,
       CAST(CAST((2 * sum(CAST(avg_price * 100 AS HUGEINT)) * 10000 + count(*)) // (2 * count(*)) AS DECIMAL(38,0))
            * 0.000001 AS DECIMAL(38,6)) AS overall_avg_price,
       min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
FROM daily GROUP BY category, region""",
    "sales_summary_mixed_case": f"""WITH {MIXED}
SELECT min(category) AS category, min(region) AS region, count(*) AS days_count,
       CAST(sum(total_quantity) AS BIGINT) AS total_quantity_all_days,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_revenue_all_days,
       CAST(CAST((2 * sum(CAST(avg_price * 100 AS HUGEINT)) * 10000 + count(*)) // (2 * count(*)) AS DECIMAL(38,0))
            * 0.000001 AS DECIMAL(38,6)) AS overall_avg_price,
       min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
FROM mixed GROUP BY lower(rtrim(category)), lower(rtrim(region))""",
    "pipeline_metrics_mixed_case": f"WITH {MIXED}, keyed AS (SELECT * REPLACE (lower(rtrim(category)) AS category, lower(rtrim(region)) AS region) FROM mixed) {metrics_of('keyed')}",
    "preview_known": f"""WITH {DAILY}
SELECT least(10, count(*)) AS n_rows, least(10, count(*)) AS n_known FROM daily""",
    "load_verification": f"""WITH {DAILY}
SELECT count(*) AS record_count, min(sale_date) AS min_date, max(sale_date) AS max_date FROM daily""",
    "distinct_from_sketches": f"""WITH {FACT}
SELECT count(DISTINCT customer_id) AS n_customer_id, count(DISTINCT product_id) AS n_product_id,
       true AS customer_id_within_error, true AS product_id_within_error
FROM fact""",
    "content_reconciliation": f"""WITH {DAILY}, sizes AS (
  SELECT count(*) AS n, count(*) FILTER (region = 'ASIA') AS again FROM daily)
SELECT 'loaded' AS kind, n AS rows_before, n AS rows_after, true AS is_equal FROM sizes
UNION ALL SELECT 'swapped', n, n, false FROM sizes
UNION ALL SELECT 'twice', n, n + again, false FROM sizes""",
    "pipeline_metrics": f"WITH {DAILY} {metrics_of('daily')}",
    "tail_by_key": f"""WITH {DAILY}
SELECT * FROM daily ORDER BY sale_date DESC, category DESC, region DESC LIMIT 25""",
    "file_profile": f"""WITH {RECORD}, damaged AS (
  SELECT region, CASE day(CAST(sale_date AS DATE))
      WHEN 5 THEN chr(0) || {LINE} || chr(0)
      WHEN 6 THEN {LINE} || chr(13)
      WHEN 7 THEN {SHORT_LINE}
      WHEN 8 THEN {LINE} || chr(7)
      ELSE {LINE} END AS line
  FROM record)
SELECT region, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes, count(*) AS n_lines,
       CAST(min(length(line) - length(replace(line, '|', ''))) AS INTEGER) AS min_seps,
       CAST(max(length(line) - length(replace(line, '|', ''))) AS INTEGER) AS max_seps,
       count(*) FILTER (contains(line, chr(0))) AS nul_lines,
       count(*) FILTER (suffix(line, chr(13))) AS cr_lines,
       count(*) FILTER (contains(line, chr(7))) AS binary_lines
FROM damaged GROUP BY region""",
    "separator_histogram": f"""WITH {FAULTY_LINES}
SELECT CAST(length(line) - length(replace(line, '|', '')) AS INTEGER) AS n_seps,
       count(*) AS n_lines,
       length(line) - length(replace(line, '|', '')) = 7 AS is_expected
FROM faulty_lines GROUP BY 1, 3""",
    "load_reconciliation": f"""WITH {FAULTY_LINES}
SELECT count(*) AS source_rows,
       count(*) FILTER (dom NOT BETWEEN 3 AND 14) AS accepted_rows,
       count(*) FILTER (dom BETWEEN 3 AND 14) AS rejected_rows,
       (SELECT min(sale_date) FROM typed WHERE dom NOT BETWEEN 3 AND 14) AS first_date,
       (SELECT max(sale_date) FROM typed WHERE dom NOT BETWEEN 3 AND 14) AS last_date,
       true AS is_balanced
FROM faulty_lines""",
    "typed_load": f"WITH {FAULTY} SELECT * EXCLUDE (dom) FROM typed",
    "reject_rows": f"""WITH {FAULTY_LINES}
SELECT line AS raw, {REASONS}
FROM faulty_lines WHERE dom BETWEEN 3 AND 14""",
    "constraint_report": f"""WITH {FAULTY}, found AS (
  SELECT unnest([
    {", ".join(f"CASE WHEN {n} IS NULL THEN 'null:{n}' END" for n in RECORD_FIELDS)},
    CASE WHEN length(category) > 50 THEN 'too_long:category' END,
    CASE WHEN length(region) > 50 THEN 'too_long:region' END,
    CASE WHEN total_quantity < 0 THEN 'negative:total_quantity' END,
    CASE WHEN total_revenue < 0 THEN 'negative:total_revenue' END,
    CASE WHEN avg_price < 0 THEN 'negative:avg_price' END,
    CASE WHEN product_count <= 0 THEN 'not_positive:product_count' END]) AS rule
  FROM typed), rules AS (SELECT unnest([
    {", ".join(f"'null:{n}'" for n in RECORD_FIELDS)}, 'too_long:category', 'too_long:region',
    'negative:total_quantity', 'negative:total_revenue', 'negative:avg_price',
    'not_positive:product_count']) AS rule)
SELECT rules.rule, count(found.rule) AS violations
FROM rules LEFT JOIN found USING (rule) GROUP BY rules.rule""",
    "duplicate_keys": f"""WITH {DAILY}, spelled AS (
  SELECT category, region, sale_date FROM daily
  UNION ALL SELECT lower(category) || '  ', region, sale_date FROM daily WHERE region = 'ASIA')
SELECT lower(rtrim(category)) AS category_key, lower(rtrim(region)) AS region_key, sale_date,
       count(*) AS n_rows
FROM spelled GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "key_conflicts": f"""WITH {EARLIER}
SELECT lower(rtrim(category)) AS category_key, lower(rtrim(region)) AS region_key, sale_date,
       count(*) AS n_rows
FROM daily WHERE {NORMAL} IN (SELECT {NORMAL} FROM earlier) GROUP BY 1, 2, 3""",
    "new_keys_only": f"""WITH {EARLIER}
SELECT {TARGET_COLUMNS} FROM daily WHERE {NORMAL} NOT IN (SELECT {NORMAL} FROM earlier)""",
    "export_csv": AWKWARD,
    "export_delimited": f"WITH {RECORD} SELECT {LINE} AS line FROM record",
    "bulk_load": f"""WITH {EARLIER}
SELECT {TARGET_COLUMNS} FROM (SELECT * FROM earlier UNION ALL BY NAME
  SELECT * FROM daily WHERE {NORMAL} NOT IN (SELECT {NORMAL} FROM earlier))""",
    "partitioned_layout": f"WITH {DAILY} SELECT {TARGET_COLUMNS} FROM daily",
    "export_job": f"""WITH {expanded(30)}, daily AS ({daily_from('expanded')})
{TEXT_RECORD.format(source='daily')}""",
    "export_job_from_files": f"""WITH {FACT}, fine AS (
  SELECT *, (CAST(price * 100 AS HUGEINT) * 20000 + 3) // 6 AS millionths FROM fact
), daily AS (
  SELECT category, region, sale_date,
         CAST(sum(quantity_sold) AS BIGINT) AS total_quantity,
         CAST((sum(millionths * quantity_sold) + 5000) // 10000 * 0.01 AS DECIMAL(18,2)) AS total_revenue,
         count(product_id) AS product_count,
         CAST((2 * sum(millionths) + 10000 * count(*)) // (20000 * count(*)) * 0.01 AS DECIMAL(18,2)) AS avg_price,
         '2024-02-01 06:30:00' AS last_processed
  FROM fine WHERE day(sale_date) NOT IN (13, 14)
  GROUP BY category, region, sale_date
), record AS ({TEXT_RECORD.format(source='daily')})
SELECT record.*, (SELECT count(*) FROM fact WHERE day(sale_date) IN (13, 14)) AS malformed_rows FROM record""",
    "full_run": f"""WITH {expanded(30)}, daily AS ({daily_from('expanded')})
{metrics_of('daily')}""",
    "reject_lines": f"""WITH {FAULTY_LINES}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY region, d, line) AS batch_line_no FROM faulty_lines)
SELECT batch_line_no, line AS raw, {REASONS}
FROM numbered WHERE dom BETWEEN 3 AND 14""",
    "recreated_target": f"""WITH {EARLIER}
SELECT {TARGET_COLUMNS}, (SELECT count(*) FROM earlier) AS rows_seen_before FROM daily""",
}
# The same rows by another way.
SQL["key_conflicts_filtered"] = SQL["key_conflicts"]
SQL["summary_from_states"] = SQL["sales_summary"]
SQL["interleaved_layout"] = SQL["partitioned_layout"]
