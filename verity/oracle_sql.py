"""Independent DuckDB SQL for every registered key.

Written directly from the operator definitions, not generated from the Spark
plans. The tables ``region nation customer supplier part orders lineitem``
are expected as views; the fixture views and the pipeline are CTEs.
"""
from __future__ import annotations

from verity import constants as K
from verity.sources.fixtures import FIXTURE_MAX_DATE, FIXTURE_MIN_DATE

FIXTURES = r"""
customers AS (
  SELECT concat('C', c_custkey) AS customer_id, c_name AS customer_name,
         concat('u', c_custkey, '@example.com') AS email, lower(r_name) AS region,
         concat('20', lpad(CAST(22 + c_custkey % 3 AS VARCHAR), 2, '0'), '-01-15') AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT concat('P', p_partkey) AS product_id, p_name AS product_name,
         p_type AS category, p_retailprice AS unit_price
  FROM part),
rt_base AS (
  SELECT l.*, o.o_custkey, (l_orderkey*31 + l_linenumber*17 + l_partkey) AS h
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey),
raw_transactions AS (
  SELECT concat('T', l_orderkey, '-', l_linenumber) AS transaction_id,
    CASE WHEN h%60=1 THEN '' WHEN h%120=2 THEN NULL WHEN h%70=5 THEN 'C-UNKNOWN'
         WHEN h%50=3 THEN concat('  C', o_custkey, ' ') ELSE concat('C', o_custkey) END AS customer_id,
    CASE WHEN h%70=6 THEN 'P-UNKNOWN' ELSE concat('P', l_partkey) END AS product_id,
    CASE WHEN h%240=10 THEN '2031-01-01' WHEN h%240=90 THEN 'not-a-date' WHEN h%240=170 THEN '2019-13-40'
         WHEN h%10<7 THEN strftime(l_shipdate,'%Y-%m-%d') ELSE strftime(l_shipdate,'%m/%d/%Y') END AS transaction_date,
    CASE WHEN h%60=7 THEN '' WHEN h%240=8 THEN '0.00' WHEN h%240=88 THEN '-45.00' WHEN h%240=168 THEN 'N/A'
         WHEN h%997=0 THEN '99999999999.00' WHEN h%500=9 THEN format('{:.2f}', l_extendedprice*20)
         WHEN h%10<5 THEN format('{:.2f}', l_extendedprice)
         WHEN h%10<8 THEN concat('$', format('{:,.2f}', l_extendedprice)) ELSE format('{:,.2f}', l_extendedprice) END AS amount,
    CAST(l_quantity AS INT) AS quantity,
    CASE WHEN h%25=10 THEN NULL WHEN h%5<3 THEN '' WHEN h%5=3 THEN 'SAVE10' ELSE 'WELCOME5' END AS promo_code,
    strftime(l_shipdate + to_hours(CAST(l_suppkey%48+1 AS INT)), '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp,
    concat('batch_', l_linestatus, '.csv') AS source_file
  FROM rt_base)"""

AMOUNT_EXPR = r"""CASE WHEN regexp_matches(regexp_replace(amount, '[$,\s]', '', 'g'), '^-?\d+(\.\d+)?$')
              THEN TRY_CAST(regexp_replace(amount, '[$,\s]', '', 'g') AS DECIMAL(10,2)) END"""

DATE_EXPR = r"""COALESCE(
           CASE WHEN regexp_matches(transaction_date, '^\d{4}-\d{2}-\d{2}$')
                THEN CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) END,
           CASE WHEN regexp_matches(transaction_date, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$')
                THEN CAST(try_strptime(transaction_date, '%m/%d/%Y') AS DATE) END)"""

PIPELINE = r"""
typed AS (
  SELECT trim(transaction_id) AS transaction_id, trim(customer_id) AS customer_id,
         trim(product_id) AS product_id,
         __AMOUNT__ AS amount,
         __DATE__ AS transaction_date,
         TRY_CAST(quantity AS INTEGER) AS quantity,
         CASE WHEN promo_code IS NULL OR trim(promo_code) = '' THEN 'NONE' ELSE promo_code END AS promo_code,
         (promo_code IS NULL OR trim(promo_code) = '') AS is_imputed,
         TRY_CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp,
         source_file
  FROM raw_transactions),
typed_flags AS (
  SELECT *, (transaction_id IS NULL OR trim(transaction_id) = ''
             OR customer_id IS NULL OR trim(customer_id) = ''
             OR product_id IS NULL OR trim(product_id) = '') AS missing_required
  FROM typed),
ceiling AS (
  SELECT COALESCE(NULLIF(quantile_disc(amount, 0.99), 0) * 3.0, 1000000) AS ceiling FROM typed),
known_customers AS (SELECT DISTINCT trim(customer_id) AS k FROM customers WHERE customer_id IS NOT NULL),
known_products AS (SELECT DISTINCT trim(product_id) AS k FROM products WHERE product_id IS NOT NULL),
checked AS (
  SELECT t.*, kc.k IS NOT NULL AS valid_customer_ref, kp.k IS NOT NULL AS valid_product_ref
  FROM typed_flags t
  LEFT JOIN known_customers kc ON t.customer_id = kc.k
  LEFT JOIN known_products kp ON t.product_id = kp.k),
validated AS (
  SELECT c.*,
    COALESCE(amount IS NOT NULL AND amount > 0 AND amount <= (SELECT ceiling FROM ceiling), false) AS valid_amount,
    COALESCE(transaction_date IS NOT NULL
             AND transaction_date BETWEEN DATE '__MIN__' AND DATE '__MAX__', false) AS valid_date
  FROM checked c),
tagged AS (
  SELECT *, CASE WHEN missing_required THEN 'missing_required_field'
                 WHEN NOT valid_amount THEN 'invalid_amount'
                 WHEN NOT valid_date THEN 'invalid_date'
                 WHEN NOT (valid_customer_ref AND valid_product_ref) THEN 'orphan_reference'
            END AS reject_reason
  FROM validated),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
      ingestion_timestamp DESC NULLS LAST, source_file ASC NULLS FIRST,
      customer_id ASC NULLS FIRST, product_id ASC NULLS FIRST, amount ASC NULLS FIRST,
      transaction_date ASC NULLS FIRST, quantity ASC NULLS FIRST, promo_code ASC NULLS FIRST,
      is_imputed ASC NULLS FIRST) AS rn
  FROM tagged WHERE reject_reason IS NULL),
curated AS (
  SELECT transaction_id, customer_id, product_id, amount, transaction_date, quantity, promo_code,
         is_imputed, ingestion_timestamp, source_file, 'fixture' AS run_id,
         strftime(transaction_date, '%Y') AS year, strftime(transaction_date, '%m') AS month,
         strftime(transaction_date, '%d') AS day
  FROM ranked WHERE rn = 1),
rejected AS (
  SELECT transaction_id, customer_id, product_id, amount, transaction_date, quantity, promo_code,
         ingestion_timestamp, source_file, reject_reason, 'fixture' AS run_id
  FROM tagged WHERE reject_reason IS NOT NULL),
pub_customers AS (
  SELECT trim(customer_id) AS customer_id, customer_name, email, region,
         TRY_CAST(signup_date AS DATE) AS signup_date FROM customers),
pub_products AS (
  SELECT trim(product_id) AS product_id, product_name, category,
         TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price FROM products),
monthly AS (
  SELECT year, month, SUM(amount) AS revenue, COUNT(*) AS orders FROM curated GROUP BY year, month)
""".replace("__AMOUNT__", AMOUNT_EXPR).replace("__DATE__", DATE_EXPR).replace("__MIN__", FIXTURE_MIN_DATE).replace("__MAX__", FIXTURE_MAX_DATE)


def _with(body: str) -> str:
    return "WITH " + FIXTURES.strip() + ",\n" + PIPELINE.strip() + "\n" + body.strip()


# What a value of each candidate type looks like, and the type it must cast to.
SHAPES = (("bigint", "^[+-]?[0-9]+$", "BIGINT"),
          ("double", "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$", "DOUBLE"),
          ("date", "^[0-9]{4}(-[0-9]{2}){2}$", "DATE"),
          ("timestamp", "^[0-9]{4}(-[0-9]{2}){2}[ T][0-9]{2}(:[0-9]{2}){2}([.][0-9]{1,6})?$", "TIMESTAMP"))


def _profile_sql() -> str:
    cols = ["transaction_id", "customer_id", "product_id", "transaction_date", "amount",
            "quantity", "promo_code", "ingestion_timestamp", "source_file"]
    parts = []
    for c in cols:
        text = f"CAST({c} AS VARCHAR)"
        counts = ", ".join(
            f"COUNT(*) FILTER (WHERE regexp_matches({text}, '{shape}') "
            f"AND TRY_CAST({text} AS {cast}) IS NOT NULL) AS n_{name}"
            for name, shape, cast in SHAPES)
        parts.append(f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, "
                     f"COUNT(*) FILTER (WHERE {text} IS NULL) AS n_null, {counts}, "
                     f"'string' AS declared_type FROM raw_transactions")
    return "\nUNION ALL\n".join(parts)


def _top_products(measure_sql: str, name: str) -> str:
    return _with(f"""
SELECT p.product_name, {measure_sql} AS {name}
FROM curated t JOIN pub_products p ON t.product_id = p.product_id
GROUP BY p.product_name ORDER BY {name} DESC, p.product_name LIMIT 10""")


def _top_customers(k: int) -> str:
    return _with(f"""
SELECT c.customer_id, c.customer_name, CAST(SUM(t.amount) AS DOUBLE) AS lifetime_spend,
       COUNT(*) AS orders
FROM curated t JOIN pub_customers c ON t.customer_id = c.customer_id
GROUP BY c.customer_id, c.customer_name
ORDER BY SUM(t.amount) DESC, c.customer_id, c.customer_name LIMIT {k}""")


def _fp_fields() -> str:
    """The portable fingerprint's row text (see ``portable_row_hash``)."""
    parts = []
    for c in ("transaction_id", "customer_id", "product_id", "amount", "transaction_date"):
        t = f"CAST({c} AS VARCHAR)"
        parts.append(f"CASE WHEN {c} IS NULL THEN 'N' ELSE 'V' || length({t}) || ':' || {t} END")
    return ", ".join(parts)


CURATED_OUT = """SELECT transaction_id, customer_id, product_id, CAST(amount AS DOUBLE) AS amount,
  transaction_date, quantity, promo_code, is_imputed, ingestion_timestamp, source_file, run_id,
  year, month, day FROM curated"""

ORACLE: dict[str, str] = {
    "schema_profile": _with(_profile_sql()),
    "publish_customers": _with("SELECT * FROM pub_customers"),
    "publish_products": _with("SELECT product_id, product_name, category, "
                              "CAST(unit_price AS DOUBLE) AS unit_price FROM pub_products"),
    "standardize_names": _with("SELECT * FROM raw_transactions"),
    "parse_amount": _with(f"SELECT transaction_id, amount AS amount_raw, CAST({AMOUNT_EXPR} AS DOUBLE) AS amount "
                          "FROM raw_transactions"),
    "parse_date": _with(f"SELECT transaction_id, transaction_date AS transaction_date_raw, "
                        f"{DATE_EXPR} AS transaction_date FROM raw_transactions"),
    "parse_timestamp": _with("SELECT transaction_id, ingestion_timestamp AS ingestion_timestamp_raw, "
                             "TRY_CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp "
                             "FROM raw_transactions"),
    "trim_ids": _with("SELECT transaction_id AS transaction_id_raw, customer_id AS customer_id_raw, "
                      "product_id AS product_id_raw, trim(transaction_id) AS transaction_id, "
                      "trim(customer_id) AS customer_id, trim(product_id) AS product_id "
                      "FROM raw_transactions"),
    "impute_promo": _with("SELECT transaction_id, promo_code AS promo_code_raw, "
                          "CASE WHEN promo_code IS NULL OR trim(promo_code) = '' THEN 'NONE' "
                          "ELSE promo_code END AS promo_code, "
                          "(promo_code IS NULL OR trim(promo_code) = '') AS is_imputed "
                          "FROM raw_transactions"),
    "partition_columns": _with("SELECT transaction_id, transaction_date, "
                               "strftime(transaction_date, '%Y') AS year, "
                               "strftime(transaction_date, '%m') AS month, "
                               "strftime(transaction_date, '%d') AS day FROM typed"),
    "conform_types": _with("SELECT transaction_id, TRY_CAST(CAST(quantity AS VARCHAR) AS INTEGER) AS quantity, "
                           "TRY_CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp "
                           "FROM raw_transactions"),
    "flag_missing_required": _with("SELECT transaction_id, customer_id, product_id, missing_required "
                                   "FROM typed_flags"),
    "flag_amount": _with("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, valid_amount FROM tagged"),
    "flag_date": _with("SELECT transaction_id, transaction_date, valid_date FROM tagged"),
    "reject_reason": _with("SELECT transaction_id, source_file, reject_reason FROM tagged"),
    "rejected": _with("SELECT transaction_id, customer_id, product_id, CAST(amount AS DOUBLE) AS amount, "
                      "transaction_date, quantity, promo_code, ingestion_timestamp, source_file, "
                      "reject_reason, run_id FROM rejected"),
    "check_customer_ref": _with("SELECT transaction_id, customer_id, valid_customer_ref FROM checked"),
    "check_product_ref": _with("SELECT transaction_id, product_id, valid_product_ref FROM checked"),
    "orphans": _with("""
SELECT 'customer' AS side, key, COUNT(*) AS "rows"
FROM (SELECT trim(customer_id) AS key FROM raw_transactions) f
WHERE key IS NOT NULL AND key <> '' AND NOT EXISTS (SELECT 1 FROM known_customers k WHERE k.k = f.key)
GROUP BY key
UNION ALL
SELECT 'product' AS side, key, COUNT(*) AS "rows"
FROM (SELECT trim(product_id) AS key FROM raw_transactions) f
WHERE key IS NOT NULL AND key <> '' AND NOT EXISTS (SELECT 1 FROM known_products k WHERE k.k = f.key)
GROUP BY key"""),
    "funnel": _with("""
SELECT raw_count, rejected_count, curated_count,
       raw_count - rejected_count - curated_count AS duplicates_dropped
FROM (SELECT COUNT(*) AS raw_count, COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected_count,
             (SELECT COUNT(*) FROM curated) AS curated_count FROM tagged)"""),
    "amount_ceiling": _with("SELECT CAST(ceiling AS DOUBLE) AS amount_ceiling FROM ceiling"),
    "monthly_revenue": _with("SELECT year, month, CAST(revenue AS DOUBLE) AS revenue, orders "
                             "FROM monthly ORDER BY year, month"),
    "top_products": _top_products("CAST(SUM(t.amount) AS DOUBLE)", "revenue"),
    "top_customers": _top_customers(20),
    "avg_order_value": _with("""
SELECT p.category, ROUND(CAST(SUM(t.amount) AS DOUBLE) / COUNT(*), 2) AS avg_order_value,
       COUNT(*) AS orders
FROM curated t JOIN pub_products p ON t.product_id = p.product_id
GROUP BY p.category ORDER BY avg_order_value DESC, p.category"""),
    "reject_rate": _with("""
SELECT reject_reason, COUNT(*) AS rows_rejected,
       CAST(ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS DOUBLE) AS pct_of_all_rejects
FROM rejected GROUP BY reject_reason ORDER BY rows_rejected DESC, reject_reason"""),
    "top_products_by_volume": _top_products("COUNT(*)", "transaction_count"),
    "top_products_by_units": _top_products("CAST(SUM(t.quantity) AS BIGINT)", "units_sold"),
    "top_products_by_id": _with("""
SELECT t.product_id, p.product_name, COUNT(*) AS transaction_count
FROM curated t JOIN pub_products p ON t.product_id = p.product_id
GROUP BY t.product_id, p.product_name
ORDER BY transaction_count DESC, t.product_id, p.product_name LIMIT 10"""),
    "curated_count": _with("SELECT COUNT(*) AS curated_count FROM curated"),
    "dedupe": _with("SELECT transaction_id, customer_id, product_id, CAST(amount AS DOUBLE) AS amount, "
                    "transaction_date, source_file FROM curated"),
    "mom_growth": _with("""
SELECT year, month, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue - LAG(revenue) OVER (ORDER BY year, month) AS DOUBLE) AS mom_change
FROM monthly ORDER BY year, month"""),
    "top_10_customers": _top_customers(10),
    "rerun_compare": _with("""
SELECT n AS rows_a, n AS rows_b, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b,
       true AS identical
FROM (SELECT COUNT(*) AS n FROM curated)"""),
    "fingerprint": _with(f"""
SELECT COUNT(*) AS n_rows, CAST(COALESCE(SUM(h), 0) AS DECIMAL(38,0)) AS hash_sum,
       COALESCE(bit_xor(h), CAST(0 AS BIGINT)) AS hash_xor
FROM (SELECT CAST(('0x' || substr(md5(concat({_fp_fields()})), 1, 15)) AS BIGINT) AS h
      FROM curated) f"""),
    "curated": _with(CURATED_OUT),
    "run_health": _with(f"""
SELECT r.source_file AS run_id, '{K.STAGE_CLEAN_AND_CURATE}' AS stage, r.raw_count, r.rejected_count,
       COALESCE(c.curated_count, 0) AS curated_count,
       CAST(ROUND(r.rejected_count * 100.0 / NULLIF(r.raw_count, 0), 2) AS DOUBLE) AS pct_rejected,
       strftime(r.max_ts, '%Y-%m-%dT%H:%M:%S') AS ts
FROM (SELECT source_file, COUNT(*) AS raw_count,
             COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected_count,
             MAX(ingestion_timestamp) AS max_ts
      FROM tagged GROUP BY source_file) r
LEFT JOIN (SELECT source_file, COUNT(*) AS curated_count FROM curated GROUP BY source_file) c
  ON r.source_file = c.source_file
ORDER BY ts DESC, run_id, stage"""),
}

# What the job wrote equals what the frames say; a merge of the same batch
# changes nothing.
ORACLE["curated_readback"] = ORACLE["merged_readback"] = ORACLE["curated"]
ORACLE["rejected_readback"] = f"SELECT * REPLACE (NULLIF(customer_id, '') AS customer_id) FROM ({ORACLE['rejected']})"
ORACLE["metrics_readback"] = _with(f"""
SELECT 'fixture' AS run_id, '{K.STAGE_CLEAN_AND_CURATE}' AS stage,
       (SELECT COUNT(*) FROM tagged) AS raw_count, (SELECT COUNT(*) FROM rejected) AS rejected_count,
       (SELECT COUNT(*) FROM curated) AS curated_count""")
ORACLE["catalog_counts"] = _with("""
SELECT 'curated.transactions' AS table_name, COUNT(*) AS n_rows FROM curated
UNION ALL SELECT 'curated.customers', COUNT(*) FROM customers
UNION ALL SELECT 'curated.products', COUNT(*) FROM products
UNION ALL SELECT 'curated.run_metrics', 1
UNION ALL SELECT 'rejected.transactions', COUNT(*) FROM rejected""")
ORACLE["run_difference"] = f"""
WITH a AS ({ORACLE["curated"]}), b AS ({ORACLE["curated"].replace(FIXTURE_MAX_DATE, "1998-06-30")})
SELECT (SELECT COUNT(*) FROM a) AS rows_a, (SELECT COUNT(*) FROM b) AS rows_b,
       (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a,
       (SELECT COUNT(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b,
       NOT EXISTS (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
         AND NOT EXISTS (SELECT * FROM b EXCEPT ALL SELECT * FROM a) AS identical"""


def _over(raw: str, body: str, customers: str | None = None) -> str:
    """``body`` over the pipeline with other raw transactions (a SELECT over
    ``raw_all``) and perhaps other customers (over ``customers_all``)."""
    fixtures = FIXTURES.strip().replace("raw_transactions AS (", "raw_all AS (")
    if customers:
        fixtures = fixtures.replace("customers AS (", "customers_all AS (", 1) + f",\ncustomers AS ({customers})"
    return f"WITH {fixtures},\nraw_transactions AS ({raw}),\n{PIPELINE.strip()}\n{body.strip()}"


# A merge that moves rows: the late batch wins for its ids, wherever they were.
MONTH_DATE = r"""regexp_replace(regexp_replace(transaction_date, '^(\d{4}-\d\d)-\d\d$', '\1-01'),
                 '^(\d\d)/\d\d/(\d{4})$', '\1/01/\2')"""
MONTHS = f"SELECT * REPLACE ({MONTH_DATE} AS transaction_date) FROM raw_all"
LATE = f"""SELECT * REPLACE (
  CASE WHEN quantity % 2 = 0 THEN '1996-03-05' ELSE {MONTH_DATE} END AS transaction_date,
  '2002-02-02 00:00:00' AS ingestion_timestamp, 'late.csv' AS source_file)
FROM raw_all WHERE quantity % 7 = 3"""
MERGED = f"""first_run AS ({_over(MONTHS, "SELECT * FROM curated")}),
late_run AS ({_over(LATE, "SELECT * REPLACE ('fixture-late' AS run_id) FROM curated")}),
merged AS (SELECT * FROM late_run
           UNION ALL SELECT * FROM first_run WHERE transaction_id NOT IN (SELECT transaction_id FROM late_run)),
dim_customers AS ({_with("SELECT * FROM pub_customers")}),
dim_products AS ({_with("SELECT * FROM pub_products")})"""


def _merged(body: str) -> str:
    return f"WITH {MERGED}\n{body.strip()}"


ORACLE["merge_moves"] = _merged("SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM merged")
ORACLE["released_rejects"] = f"""
SELECT 'fixture' AS run_id, reject_reason, COUNT(*) AS rows_rejected
FROM ({_with("SELECT * FROM rejected")}) GROUP BY reject_reason
UNION ALL SELECT 'fixture-late', reject_reason, COUNT(*)
FROM ({_over(LATE, "SELECT * FROM rejected")}) GROUP BY reject_reason"""
_METRICS = """SELECT '{run}' AS run_id, '{stage}' AS stage, (SELECT COUNT(*) FROM tagged) AS raw_count,
  (SELECT COUNT(*) FROM rejected) AS rejected_count, (SELECT COUNT(*) FROM curated) AS curated_count"""
ORACLE["released_metrics"] = (
    f"SELECT * FROM ({_with(_METRICS.format(run='fixture', stage=K.STAGE_CLEAN_AND_CURATE))}) UNION ALL "
    f"SELECT * FROM ({_over(LATE, _METRICS.format(run='fixture-late', stage=K.STAGE_CLEAN_AND_CURATE))})")
ORACLE["rollup_monthly_revenue"] = _merged("""
SELECT year, month, CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS orders FROM merged GROUP BY year, month""")
ORACLE["rollup_mom_growth"] = _merged("""
SELECT year, month, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue - LAG(revenue) OVER (ORDER BY year, month) AS DOUBLE) AS mom_change
FROM (SELECT year, month, SUM(amount) AS revenue FROM merged GROUP BY year, month)""")
ORACLE["rollup_top_products"] = _merged("""
SELECT product_name, CAST(SUM(amount) AS DOUBLE) AS revenue FROM merged JOIN dim_products USING (product_id)
GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 10""")
ORACLE["rollup_top_customers"] = _merged("""
SELECT customer_id, customer_name, CAST(SUM(amount) AS DOUBLE) AS lifetime_spend, COUNT(*) AS orders
FROM merged JOIN dim_customers USING (customer_id) GROUP BY customer_id, customer_name
ORDER BY lifetime_spend DESC, customer_id, customer_name LIMIT 20""")
ORACLE["rollup_avg_order_value"] = _merged("""
SELECT category, ROUND(CAST(SUM(amount) AS DOUBLE) / COUNT(*), 2) AS avg_order_value, COUNT(*) AS orders
FROM merged JOIN dim_products USING (product_id) GROUP BY category""")
ORACLE["run_difference_by_day"] = _merged("""
, one AS (SELECT * FROM first_run EXCEPT ALL SELECT * FROM merged),
two AS (SELECT * FROM merged EXCEPT ALL SELECT * FROM first_run),
days AS (SELECT year, month, day FROM one UNION SELECT year, month, day FROM two)
SELECT *, (SELECT COUNT(*) FROM first_run t WHERE (t.year, t.month, t.day) = (d.year, d.month, d.day)) AS rows_a,
       (SELECT COUNT(*) FROM merged t WHERE (t.year, t.month, t.day) = (d.year, d.month, d.day)) AS rows_b,
       (SELECT COUNT(*) FROM one t WHERE (t.year, t.month, t.day) = (d.year, d.month, d.day)) AS only_a,
       (SELECT COUNT(*) FROM two t WHERE (t.year, t.month, t.day) = (d.year, d.month, d.day)) AS only_b
FROM days d""")
ORACLE["rerun_proof"] = _over(MONTHS, """
SELECT 'curated.transactions' AS table_name, COUNT(*) AS n_rows, true AS identical FROM curated
UNION ALL SELECT 'rejected.transactions', COUNT(*), true FROM rejected""")
ORACLE["ceiling_by_day"] = _with("""
SELECT CAST(quantile_disc(CASE WHEN year(transaction_date) = 1996 THEN amount::DECIMAL(18,2) ELSE 2 * amount::DECIMAL(18,2) END,
                          0.99) * 3 AS DOUBLE) AS amount_ceiling FROM typed""")


def _drift_sql() -> str:
    landings = {"a": (0, ["transaction_id", "customer_id", "product_id", "transaction_date", "amount", "quantity",
                          "promo_code", "ingestion_timestamp", "source_file"])}
    declared = landings["a"][1]
    landings["b"] = (1, declared[:4] + ["quantity", "amount"] + declared[6:])
    landings["c"] = (2, [c for c in declared if c != "promo_code"] + ["channel_name"])
    types = {"transaction_date": "DATE", "amount": "DECIMAL(10,2)", "quantity": "INTEGER",
             "ingestion_timestamp": "TIMESTAMP"}
    parts = []
    for name, (rest, cols) in landings.items():
        for i, c in enumerate(cols):
            text = "'web'" if c == "channel_name" else f"NULLIF(CAST({c} AS VARCHAR), '')"
            shapes = ", ".join(
                f"COUNT(*) FILTER (WHERE regexp_matches({text}, '{shape}') AND TRY_CAST({text} AS {kind}) IS NOT NULL) "
                f"AS n_{label}" for label, shape, kind in SHAPES)
            fails = f"COUNT(*) FILTER (WHERE {text} IS NOT NULL AND TRY_CAST({text} AS {types[c]}) IS NULL)" \
                if c in types else "CAST(NULL AS BIGINT)"
            moved = c not in declared or declared.index(c) != i
            parts.append(
                f"SELECT '{name}' AS landing, '{c}' AS column_name, {i} AS position, {str(c in declared).lower()} AS declared, "
                f"COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {text} IS NULL) AS n_null, {shapes}, {fails} AS n_uncastable, "
                f"{str(moved).lower()} OR {fails if c in types else '0'} > 0 AS departs "
                f"FROM raw_transactions WHERE quantity % 3 = {rest}")
    zeros = ", ".join(f"0 AS n_{label}" for label, _, _ in SHAPES)
    parts.append(f"SELECT 'c' AS landing, 'promo_code' AS column_name, NULL AS position, true AS declared, 0 AS n_rows, "
                 f"0 AS n_null, {zeros}, CAST(NULL AS BIGINT) AS n_uncastable, true AS departs")
    sums = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in
                     ("n_rows", "n_null", "n_bigint", "n_double", "n_date", "n_timestamp", "n_uncastable"))
    return _with(f"SELECT landing, column_name, CAST(position AS INTEGER) AS position, declared, {sums}, departs FROM (\n"
                 + "\nUNION ALL\n".join(parts) + ")")


ORACLE["file_drift"] = _drift_sql()

HARD = """SELECT * REPLACE (
  CASE quantity % 10 WHEN 1 THEN 'not-a-time' WHEN 2 THEN '' WHEN 3 THEN '2025-02-30 10:00:00'
       ELSE ingestion_timestamp END AS ingestion_timestamp,
  CASE WHEN quantity % 10 = 4 THEN '1/5/1997' ELSE transaction_date END AS transaction_date,
  CASE quantity % 10 WHEN 5 THEN 'NONE' WHEN 6 THEN '  ' ELSE promo_code END AS promo_code,
  CASE WHEN quantity % 20 = 7 THEN NULL ELSE transaction_id END AS transaction_id)
FROM raw_all"""
PADDED = "SELECT * REPLACE (' ' || customer_id || '  ' AS customer_id) FROM customers_all"
ORACLE["curated_hard"] = _over(HARD, CURATED_OUT, PADDED)
ORACLE["rejected_hard"] = _over(
    HARD, "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM rejected", PADDED)
ORACLE["conform_raw"] = _over(HARD, """
SELECT transaction_id, customer_id, product_id, TRY_CAST(transaction_date AS DATE) AS transaction_date,
       CAST(TRY_CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS amount, quantity, promo_code,
       TRY_CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp, source_file
FROM raw_transactions""")
