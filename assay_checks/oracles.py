"""Plain SQL for every checked query, over the star-schema tables."""

from __future__ import annotations

BRONZE = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'not-a-date'
       ELSE CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) END AS order_date,
  CASE WHEN o_custkey % 83 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN c_nationkey = 24 THEN NULL ELSE n_name END AS country,
  CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE p_type END AS product,
  CASE WHEN l_partkey % 71 = 0 THEN '-3' WHEN l_partkey % 73 = 0 THEN '0'
       WHEN l_partkey % 79 = 0 THEN 'abc'
       WHEN l_partkey % 43 = 0 THEN ' ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.7 '
       ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
  CASE WHEN l_suppkey % 61 = 0 THEN '0.00' WHEN l_suppkey % 59 = 0 THEN ''
       WHEN l_suppkey % 53 = 0 THEN '-1.50'
       ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
"""

TYPED = r"""
SELECT *, quantity * unit_price AS total_amount FROM (
  SELECT order_id, TRY_CAST(order_date AS DATE) AS order_date, customer_id, country, product,
    TRY_CAST(regexp_extract(quantity, '^ *([+-]?[0-9]+)([.][0-9]*)? *$', 1) AS INT) AS quantity,
    TRY_CAST(unit_price AS DOUBLE) AS unit_price
  FROM bronze) t
"""

BASIC = """
SELECT * FROM typed
WHERE order_id IS NOT NULL AND order_date IS NOT NULL AND customer_id IS NOT NULL
"""

VALID = "SELECT * FROM basic WHERE quantity > 0 AND unit_price > 0.0"

SILVER = """
SELECT order_id, order_date, customer_id, country, product, quantity, unit_price, total_amount
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date NULLS LAST,
    customer_id NULLS LAST, country NULLS LAST, product NULLS LAST, quantity NULLS LAST,
    unit_price NULLS LAST) AS rn
  FROM valid) q
WHERE rn = 1
"""


def _rollup(source: str) -> str:
    return f"""
SELECT order_date, country, product, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  CAST(sum(CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) / count(unit_price) AS avg_unit_price
FROM {source} GROUP BY order_date, country, product
"""


GOLD_CLEAN = """
SELECT * FROM gold WHERE order_date IS NOT NULL AND country IS NOT NULL AND product IS NOT NULL
  AND total_quantity >= 0 AND total_revenue >= 0.0
"""

# Made orders, one per key of the orders table.
GENERATED = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  '2024-01-05' AS order_date,
  CAST(100 + h('customer_id', o_orderkey) % 101 AS VARCHAR) AS customer_id,
  CASE h('country', o_orderkey) % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' ELSE 'MX' END AS country,
  CASE h('product', o_orderkey) % 3 WHEN 0 THEN 'Widget A' WHEN 1 THEN 'Widget B'
       ELSE 'Widget C' END AS product,
  CAST(1 + h('quantity', o_orderkey) % 10 AS VARCHAR) AS quantity,
  CASE h('unit_price', o_orderkey) % 3 WHEN 0 THEN '9.99' WHEN 1 THEN '19.99'
       ELSE '29.99' END AS unit_price
FROM orders
"""
for _column in ("customer_id", "country", "product", "quantity", "unit_price"):
    GENERATED = GENERATED.replace(
        f"h('{_column}', o_orderkey)",
        f"CAST('0x' || substr(md5('42|{_column}|' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)",
    )


def with_stages(final: str, bronze: str = BRONZE) -> str:
    stages = {
        "bronze": bronze,
        "typed": TYPED,
        "basic": BASIC,
        "valid": VALID,
        "silver": SILVER,
        "gold": _rollup("silver"),
        "gold_clean": GOLD_CLEAN,
    }
    steps = ",\n".join(f"{name} AS ({text})" for name, text in stages.items())
    return f"WITH {steps}\n{final}"


# Prices in quarters, summed as doubles: exact in any order.
QUARTERS = """
SELECT order_date, country, product, quantity, floor(unit_price * 4) / 4 AS price FROM silver
"""


def _double_rollup(mean: str, rule: str) -> str:
    return with_stages(
        "SELECT order_date, country, product, CAST(sum(quantity) AS BIGINT) AS total_quantity,"
        f" sum(quantity * price) AS total_revenue{mean} FROM ({QUARTERS}) q"
        f" GROUP BY order_date, country, product{rule}"
    )


# Whole numbers of 2**-20, summed exactly and rounded to 53 bits by hand, half to even.
ANY_AMOUNT = """
SELECT order_date, country, product, total_quantity,
  CASE WHEN cut = 0 THEN CAST(total AS DOUBLE) ELSE CAST(top + CASE WHEN 2 * rest > unit OR
    (2 * rest = unit AND top % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) * pow(CAST(2 AS DOUBLE), cut) END
    / pow(CAST(2 AS DOUBLE), 20) AS total_revenue, avg_unit_price
FROM (SELECT *, total // unit AS top, total % unit AS rest FROM (
  SELECT *, CAST(1 AS HUGEINT) << cut AS unit FROM (
    SELECT *, greatest(0, CAST(floor(log2(CAST(total AS DOUBLE))) AS INT) - 52) AS cut FROM (
      SELECT order_date, country, product, CAST(sum(quantity) AS BIGINT) AS total_quantity,
        CAST(sum(CAST(quantity AS HUGEINT) << power) AS HUGEINT) AS total,
        sum(price) / count(price) AS avg_unit_price
      FROM (SELECT *, CAST((CAST(split_part(order_id, '-', 1) AS BIGINT) * 7
          + CAST(split_part(order_id, '-', 2) AS INT)) % 61 AS INT) AS power
        FROM (SELECT order_id, order_date, country, product, quantity, floor(unit_price * 4) / 4 AS price
          FROM silver) q) r
      WHERE order_date IS NOT NULL AND country IS NOT NULL AND product IS NOT NULL
      GROUP BY order_date, country, product) g) c) u) p
"""

# Line 0 of 3 has lost its country.
DRIFTED = """
SELECT order_id, order_date, customer_id,
  CASE WHEN CAST(split_part(order_id, '-', 2) AS INT) % 3 = 0 THEN NULL ELSE country END AS country,
  product, quantity, NULLIF(unit_price, '') AS unit_price
FROM bronze
"""

BROKEN = """
SELECT * REPLACE (CASE WHEN CAST(customer_id AS INT) % 7 = 0 THEN replace(product, ' ', chr(10))
  ELSE product END AS product)
FROM silver
"""

# A third of the lines comes again with another product.
LATE = f"""
SELECT * FROM ({BRONZE}) first
UNION ALL
SELECT * REPLACE ('A late copy' AS product) FROM ({BRONZE}) again
WHERE CAST(split_part(order_id, '-', 2) AS INT) % 3 = 0
"""

# What silver turns away, as it came, with the first rule that it failed.
REJECTED = r"""
SELECT order_id, order_date, customer_id, country, product, quantity, unit_price, reason FROM (
  SELECT *, coalesce(rule, CASE WHEN row_number() OVER (PARTITION BY order_id, rule ORDER BY d NULLS LAST,
    customer_id NULLS LAST, country NULLS LAST, product NULLS LAST, q NULLS LAST, p NULLS LAST,
    order_date, customer_id, country, product, quantity, unit_price) > 1 THEN 'duplicate' END) AS reason
  FROM (
    SELECT *, CASE WHEN order_id IS NULL THEN 'missing order_id' WHEN d IS NULL THEN 'missing order_date'
      WHEN customer_id IS NULL THEN 'missing customer_id'
      WHEN q IS NULL OR q <= 0 THEN 'quantity not positive'
      WHEN p IS NULL OR p <= 0 THEN 'unit_price not positive' END AS rule
    FROM (
      SELECT *, TRY_CAST(order_date AS DATE) AS d, TRY_CAST(unit_price AS DOUBLE) AS p,
        TRY_CAST(regexp_extract(quantity, '^ *([+-]?[0-9]+)([.][0-9]*)? *$', 1) AS INT) AS q
      FROM bronze) t) r) j
WHERE reason IS NOT NULL
"""

_D = "SELECT * FROM gold_clean"
_S = "SELECT * FROM silver"
_REPORT = (
    "SELECT order_date, country, product, total_quantity, total_revenue FROM gold_clean"
    " ORDER BY order_date, country, product"
)

ORACLES: dict[str, str] = {
    "align_schema": with_stages(
        "SELECT order_id, order_date, customer_id, CAST(NULL AS VARCHAR) AS country, product,"
        " quantity, unit_price FROM bronze"
    ),
    "typed_orders": with_stages("SELECT * FROM typed"),
    "drop_missing_critical": with_stages("SELECT * FROM basic"),
    "positive_measures": with_stages("SELECT * FROM typed WHERE quantity > 0 AND unit_price > 0.0"),
    "dedup_orders": with_stages(_S),
    "silver_orders": with_stages(_S),
    "silver_orders_basic": with_stages("SELECT * FROM basic"),
    "dq_metrics_silver": with_stages(
        "SELECT raw_rows, clean_rows, raw_rows - clean_rows AS removed_rows FROM"
        " (SELECT (SELECT count(*) FROM bronze) AS raw_rows,"
        " (SELECT count(*) FROM silver) AS clean_rows) c"
    ),
    "gold_orders": with_stages(_D),
    "gold_orders_basic": with_stages(
        "SELECT order_date, country, product, CAST(sum(quantity) AS BIGINT) AS total_quantity,"
        " CAST(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue"
        " FROM silver GROUP BY order_date, country, product"
    ),
    "gold_having": with_stages(
        f"SELECT * FROM ({_rollup('basic')}) g WHERE total_quantity >= 0 AND total_revenue >= 0.0"
    ),
    "dq_metrics_gold": with_stages(
        "SELECT (SELECT count(*) FROM silver) AS silver_rows,"
        " (SELECT count(*) FROM gold) AS gold_rows,"
        " (SELECT count(*) FROM gold_clean) AS gold_clean_rows"
    ),
    "gold_orders_double": _double_rollup(
        ", sum(price) / count(price) AS avg_unit_price",
        " HAVING order_date IS NOT NULL AND country IS NOT NULL AND product IS NOT NULL"
        " AND sum(quantity) >= 0 AND sum(quantity * price) >= 0",
    ),
    "gold_basic_double": _double_rollup("", ""),
    "gold_orders_any_amount": with_stages(ANY_AMOUNT),
    "silver_basic_mixed_case": with_stages(
        "SELECT order_id, order_date, customer_id, country, product, quantity, unit_price,"
        " total_amount FROM basic"
    ),
    "bronze_mixed_layout": with_stages(
        "SELECT order_id, order_date, customer_id, country, product, quantity,"
        " NULLIF(unit_price, '') AS unit_price FROM bronze"
    ),
    "bronze_drifted_headers": with_stages(DRIFTED),
    "bronze_line_breaks_roundtrip": with_stages(BROKEN),
    "medallion_from_catalog": with_stages(_D),
    "bronze_csv_roundtrip": with_stages(
        "SELECT order_id, order_date, customer_id, country, product, quantity,"
        " NULLIF(unit_price, '') AS unit_price FROM bronze"
    ),
    "silver_flat_roundtrip": with_stages(_S),
    "silver_partitioned_roundtrip": with_stages(_S),
    "silver_append_roundtrip": with_stages("SELECT * FROM basic UNION ALL SELECT * FROM basic"),
    "gold_partitioned_roundtrip": with_stages(_D),
    "gold_flat_roundtrip": with_stages(_D),
    "gold_basic_roundtrip": with_stages(
        "SELECT order_date, country, product, total_quantity, total_revenue FROM gold"
    ),
    "partition_fallback": with_stages(_D),
    "empty_guard": with_stages(_D),
    "catalog_roundtrip": with_stages(_S),
    "silver_inspect": with_stages("SELECT * FROM silver ORDER BY order_id LIMIT 10"),
    "gold_report": with_stages(_REPORT),
    "catalog_sql_report": with_stages(_REPORT),
    "generate_orders": GENERATED,
    "medallion_end_to_end": with_stages(_D),
    "bronze_blank_heads": with_stages(
        "SELECT order_id, order_date, customer_id, country, product, quantity,"
        " NULLIF(unit_price, '') AS unit_price FROM bronze"
    ),
    "bronze_manifest_counts": with_stages(
        "SELECT (SELECT count(*) FROM bronze WHERE CAST(split_part(order_id, '-', 2) AS INT) % 3 < 2)"
        " AS landed_rows, raw_rows, clean_rows, raw_rows - clean_rows AS removed_rows FROM"
        " (SELECT (SELECT count(*) FROM bronze) AS raw_rows,"
        " (SELECT count(*) FROM silver) AS clean_rows) c"
    ),
    "silver_publish_recovery": with_stages(
        "SELECT *, 'after the kill' AS seen FROM silver"
        " WHERE CAST(split_part(order_id, '-', 2) AS INT) % 3 <> 2"
        " UNION ALL SELECT *, 'after the rerun' AS seen FROM silver"
    ),
    "silver_incremental": with_stages(_S, bronze=LATE),
    "silver_rejected": with_stages(REJECTED),
    "silver_beside_rejected": with_stages(
        "SELECT s.*, n AS removed_rows, n AS with_reason FROM silver s,"
        " (SELECT (SELECT count(*) FROM bronze) - (SELECT count(*) FROM silver) AS n) c"
    ),
    "silver_batches_once": with_stages("SELECT * FROM basic"),
    "catalog_by_difference": with_stages(
        "SELECT * REPLACE (CASE WHEN country = 'CANADA' THEN quantity * 2 ELSE quantity END AS quantity)"
        " FROM silver"
    ),
    "partition_null_heavy": with_stages(
        "SELECT * EXCLUDE (country), CAST(0.25 AS DOUBLE) AS null_share, '' AS partitions FROM silver"
        " UNION ALL SELECT * EXCLUDE (country), CAST(0.75 AS DOUBLE), 'country' FROM silver"
    ),
    "generated_end_to_end": with_stages(_D, bronze=GENERATED),
}
