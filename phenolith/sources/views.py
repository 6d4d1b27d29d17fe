"""Record tables derived from the generic test tables.

The health-record tables (hospital episodes, diagnoses, procedures, deaths, GP data and the long
survey table) are *derived* from the star-schema test tables by one SQL text per table. The same
text runs on Spark and on DuckDB, so that every operator's oracle can rebuild identical inputs as
CTEs. All work grows with the input tables: nothing here is sampled or capped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("orders", "lineitem", "customer", "events", "part")

RAW_VIEWS: dict[str, str] = {
    "raw_hesin": """
SELECT o_custkey AS eid, o_orderkey AS ins_index,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS date) END AS epistart,
       CASE WHEN o_orderkey % 89 = 0 THEN DATE '1801-01-01' WHEN o_orderkey % 50 = 0 THEN NULL
            ELSE CAST(o_orderdate AS date) + CAST(o_orderkey % 15 AS int) END AS epiend,
       CASE WHEN o_orderstatus = 'P' OR o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS date) + CAST(1 AS int) END AS admidate,
       CASE WHEN o_orderkey % 97 = 0 THEN DATE '2037-07-07' ELSE CAST(o_orderdate AS date) + CAST(o_orderkey % 20 AS int) END AS disdate
FROM orders""",
    "raw_hesin_diag": """
SELECT o_custkey AS eid, l_orderkey AS ins_index, CAST(l_linenumber AS int) AS arr_index,
       CAST(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 2 END AS int) AS level,
       chr(CAST(65 + CAST(floor(l_partkey / 10) AS bigint) % 5 AS int)) || CAST(l_suppkey % 10 AS string)
         || CAST(l_partkey % 10 AS string) || CAST(l_linenumber AS string) AS diag_icd10
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_hesin_oper": """
SELECT o_custkey AS eid, l_orderkey AS ins_index, CAST(l_linenumber AS int) AS arr_index,
       CAST(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 2 END AS int) AS level,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_shipdate AS date) END AS opdate,
       chr(CAST(75 + l_suppkey % 5 AS int)) || CAST(l_partkey % 10 AS string)
         || CAST(CAST(floor(l_partkey / 10) AS bigint) % 10 AS string) || CAST(l_linenumber AS string) AS oper4
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_death": """
SELECT c_custkey AS eid, CAST(0 AS int) AS ins_index, DATE '2010-01-01' + CAST(c_custkey % 3000 AS int) AS date_of_death
FROM customer WHERE c_custkey % 7 = 0
UNION ALL
SELECT c_custkey, CAST(1 AS int), DATE '2010-01-01' + CAST(c_custkey % 3000 AS int)
FROM customer WHERE c_custkey % 77 = 0""",
    "raw_death_cause": """
SELECT c_custkey AS eid, CAST(0 AS int) AS ins_index, CAST(1 AS int) AS level,
       chr(CAST(65 + c_nationkey % 5 AS int)) || CAST(c_custkey % 10 AS string) || '1' AS cause_icd10
FROM customer WHERE c_custkey % 7 = 0
UNION ALL
SELECT c_custkey, CAST(0 AS int), CAST(2 AS int),
       chr(CAST(65 + c_nationkey % 3 AS int)) || CAST(c_custkey % 10 AS string) || '2'
FROM customer WHERE c_custkey % 14 = 0""",
    "raw_gp_clinical": """
SELECT user_id AS eid, CAST(1 + event_id % 4 AS int) AS data_provider,
       CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 37 = 0 THEN DATE '1902-02-02'
            WHEN event_id % 31 = 0 THEN DATE '1903-03-03' ELSE CAST(ts AS date) END AS event_dt,
       CASE WHEN event_id % 2 = 0 THEN code END AS read_2,
       CASE WHEN event_id % 2 = 1 OR event_id % 29 = 0 THEN code END AS read_3,
       CAST(value AS string) AS value1, CAST(value AS string) AS value2,
       CASE WHEN event_id % 5 = 0 THEN 'mmol/L' WHEN event_id % 5 = 1 THEN 'mg/dl' END AS value3
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN upper(substr(event_type, 1, 1)) ELSE substr(event_type, 1, 1) END
             || CAST(event_id % 9 AS string) || substr(event_type, 2, 1) || '..' AS code FROM events) e""",
    "raw_gp_registrations": """
SELECT c_custkey AS eid, CAST(1 + c_custkey % 4 AS int) AS data_provider,
       CASE WHEN c_custkey % 23 = 0 THEN DATE '1902-02-02' ELSE DATE '1990-01-01' + CAST(c_custkey % 4000 AS int) END AS reg_date,
       CASE WHEN c_custkey % 3 = 0 THEN DATE '2015-01-01' + CAST(c_custkey % 700 AS int) END AS deduct_date
FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT c_custkey, CAST(1 + c_custkey % 4 AS int), DATE '2005-01-01', CAST(NULL AS date)
FROM customer WHERE c_custkey % 8 = 0""",
    "raw_prescription_lines": """
SELECT o_custkey AS eid, CAST(1 + o_orderkey % 4 AS int) AS data_provider, CAST(l_shipdate AS date) AS issue_date,
       p_brand AS bnf_code, CAST(p_partkey AS string) AS dmd_code, p_name AS drug_name, CAST(l_quantity AS string) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "raw_baseline": """
SELECT CAST(eid AS bigint) AS eid, CAST(field AS int) AS field, CAST(i AS int) AS i, CAST(n AS int) AS n, value FROM (
  SELECT c_custkey AS eid, 31 AS field, 0 AS i, 0 AS n, CAST(c_custkey % 2 AS string) AS value FROM customer WHERE c_custkey % 53 <> 0
  UNION ALL SELECT c_custkey, 34, 0, 0, CAST(1937 + c_custkey % 63 AS string) FROM customer
  UNION ALL SELECT c_custkey, 52, 0, 0, CAST(1 + c_custkey % 12 AS string) FROM customer
  UNION ALL SELECT c_custkey, 53, 0, 0, CAST(DATE '2006-03-13' + CAST(c_custkey % 1660 AS int) AS string) FROM customer
  UNION ALL SELECT c_custkey, 53, 1, 0, CAST(DATE '2012-06-01' + CAST(c_custkey % 300 AS int) AS string) FROM customer WHERE c_custkey % 4 = 0
  UNION ALL SELECT c_custkey, 54, 0, 0, CAST(11001 + c_custkey % 23 AS string) FROM customer WHERE c_custkey % 59 <> 0
  UNION ALL SELECT c_custkey, 21003, 0, 0, CAST(37 + c_custkey % 36 AS string) FROM customer
  UNION ALL SELECT c_custkey, 189, 0, 0, CAST(c_acctbal AS string) FROM customer
  UNION ALL SELECT c_custkey, 20116, 0, 0, CASE WHEN c_custkey % 11 = 0 THEN '-3' ELSE CAST(c_custkey % 3 AS string) END FROM customer
  UNION ALL SELECT c_custkey, 20117, 0, 0, CASE WHEN c_custkey % 13 = 0 THEN '-3' ELSE CAST(c_custkey % 3 AS string) END FROM customer
  UNION ALL SELECT c_custkey, 21000, 0, 0, CASE WHEN c_custkey % 17 = 0 THEN '-3' WHEN c_custkey % 19 = 0 THEN '-1' ELSE CAST(1 + c_custkey % 6 AS string) || '00' || CAST(c_custkey % 3 AS string) END FROM customer
  UNION ALL SELECT c_custkey, 40000, 0, 0, CAST(DATE '2010-01-01' + CAST(c_custkey % 3000 AS int) AS string) FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT o_custkey, 20002, CAST(o_orderkey % 2 AS int), CAST(floor(o_orderkey / 2) AS int), CAST(1100 + o_orderkey % 30 AS string) FROM orders
  UNION ALL SELECT o_custkey, 20008, CAST(o_orderkey % 2 AS int), CAST(floor(o_orderkey / 2) AS int),
            CASE WHEN o_orderkey % 10 = 0 THEN '-1' ELSE CAST(year(o_orderdate) AS string) || '.5' END FROM orders WHERE o_orderkey % 9 <> 0
  UNION ALL SELECT c_custkey, 6150, 0, 0, CAST(1 + c_custkey % 4 AS string) FROM customer
  UNION ALL SELECT c_custkey, 3894, 0, 0, CASE WHEN c_custkey % 6 = 0 THEN '-1' ELSE CAST(20 + c_custkey % 40 AS string) || '.5' END FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL SELECT o_custkey, 40006, CAST(o_orderkey AS int), 0, 'C' || CAST(10 + o_orderkey % 80 AS string) FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL SELECT o_custkey, 40005, CAST(o_orderkey AS int), 0, CAST(CAST(o_orderdate AS date) AS string) FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderkey % 3 <> 0
  UNION ALL SELECT o_custkey, 20001, 0, CAST(o_orderkey AS int), CAST(1000 + o_orderkey % 7 AS string) FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT o_custkey, 20006, 0, CAST(o_orderkey AS int), CASE WHEN o_orderkey % 11 = 0 THEN '-3' ELSE CAST(year(o_orderdate) AS string) END FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderkey % 4 <> 0
  UNION ALL SELECT o_custkey, 20004, 1, CAST(o_orderkey AS int), CAST(1400 + o_orderkey % 20 AS string) FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_custkey, 20010, 1, CAST(o_orderkey AS int), CAST(year(o_orderdate) - 1 AS string) || '.5' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 5 <> 0
) x""",
}

# people without prescriptions: the cohort's flag and provider need some, and every customer has an order
RAW_VIEWS["raw_gp_prescriptions"] = RAW_VIEWS["raw_prescription_lines"] + " WHERE o_custkey % 5 = 0"

# the wide survey file (one string column per "<field>-<visit>.<slot>"), made from customer
WIDE_COLUMNS = ("31-0.0", "34-0.0", "20002-0.0", "20002-0.1", "21001-0.0", "22000")
_WIDE_EXPRS = (
    "CASE WHEN c_custkey % 53 = 0 THEN '' ELSE CAST(c_custkey % 2 AS string) END",
    "CAST(1937 + c_custkey % 63 AS string)",
    "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(1100 + c_custkey % 30 AS string) END",
    "CASE WHEN c_custkey % 4 = 0 THEN CAST(1100 + c_custkey % 17 AS string) END",
    "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_acctbal AS string) END",
    "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE CAST(c_nationkey AS string) END",
)


def wide_sql(quote: str) -> str:
    """SQL for the wide file; ``quote`` is the identifier quote of the engine (` or ")."""
    cols = ",\n       ".join(f"{e} AS {quote}{c}{quote}" for c, e in zip(WIDE_COLUMNS, _WIDE_EXPRS))
    return f"SELECT c_custkey AS eid,\n       {cols}\nFROM customer"


# lookup of field titles (ten rows), used by the per-field report
LKP_FIELDS = (
    (41202, "Diagnoses - main ICD10"),
    (41204, "Diagnoses - secondary ICD10"),
    (41200, "Operative procedures - main OPCS4"),
    (41210, "Operative procedures - secondary OPCS4"),
    (40001, "Underlying (primary) cause of death: ICD10"),
    (40002, "Contributory (secondary) causes of death: ICD10"),
    (42040, "GP clinical event records"),
    (40006, "Cancer registry type of cancer ICD-10"),
    (20002, "Non-cancer illness code, self-reported"),
    (20001, "Cancer code, self-reported"),
)

_NAME_RE = re.compile(r"\b(" + "|".join(BASE_TABLES) + r")\b")


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES}


def _spark_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    # reference the base tables as DataFrame parameters so that nothing is registered in the catalog
    return spark.sql(_NAME_RE.sub(lambda m: "{" + m.group(1) + "}", text), **tables)


def raw_view(spark: SparkSession, sf_dir: str, name: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    tables = tables or base_tables(spark, sf_dir)
    return _spark_sql(spark, RAW_VIEWS[name], tables)


def raw_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = base_tables(spark, sf_dir)
    out = {name: _spark_sql(spark, text, tables) for name, text in RAW_VIEWS.items()}
    out["raw_wide"] = _spark_sql(spark, wide_sql("`"), tables)
    return out


def lkp_fields(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LKP_FIELDS), "field_id int, title string")


def lkp_fields_sql() -> str:
    rows = ", ".join(f"({f}, '{t}')" for f, t in LKP_FIELDS)
    return f"SELECT * FROM (VALUES {rows}) v(field_id, title)"


def oracle_ctes(names: list[str] | tuple[str, ...] | None = None) -> str:
    """``WITH`` clause text defining the named raw views for DuckDB (all views if ``names`` is None)."""
    names = list(RAW_VIEWS) if names is None else list(names)
    parts = [f"{n} AS ({RAW_VIEWS[n]}\n)" for n in names if n in RAW_VIEWS]
    if "raw_wide" in names:
        parts.append(f"raw_wide AS ({wide_sql(chr(34))}\n)")
    if "lkp_fields" in names:
        parts.append(f"lkp_fields AS ({lkp_fields_sql()})")
    return "WITH " + ",\n".join(parts) + "\n"
