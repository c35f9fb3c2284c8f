"""Catalog views over the sales tables, in SQL that Spark and other engines read alike.

Table names stand in braces, so a view can be bound to frames or to tables of those names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

PUBLISHERS = (
    "U.S. GOVT. PRINT. OFF.", "GPO", "UNITED STATES. DEPARTMENT OF THE INTERIOR", "[THE] BUREAU OF THE CENSUS", "DEPTOF STATE",
    "FOR SALE BY THE SUPT. OF DOCS., U.S. G.P.O.", "Dept. of Labor, The", "UNIVERSITY OF OHIO", "ACME COMPANY INC", "NASA",
    "HENNEPIN COUNTY", "OHIO STATE DEPT OF HEALTH", "BURNS AND ROE", "US NAVAL WAR COLLEGE", "SENATE COMMITTEE ON TRADE",
)
IMPRINTS = (
    "Washington : U.S. Govt. Print. Off., 1978.", "[Austin, Tex.] : The Dept., [1987-", "Washington, D.C. : For sale by the Supt. of Docs., c1994", "GPO",
    "New York : Wiley, 19uu", "...", "Ottawa : Queen's Printer, 1965", "washington u.s. govt print off",
)
SUDOCS = ("A 13.2:F 76", "c 3.5", "y-3.1", "123.4", ".5", "II0 A 93.1", "Y4.P 9", "GP 3.1", "PR40.8", "HE 20.40")


def pick(values: tuple[str, ...], key: str) -> str:
    """SQL for one of some strings by a whole number."""
    cases = " ".join(f"WHEN {i} THEN '{v.replace(chr(39), chr(39) * 2)}'" for i, v in enumerate(values))
    return f"CASE ({key}) % {len(values)} {cases} END"


_PRIO = "substr(o_orderpriority, 1, 1)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

RECORDS = "SELECT o_orderkey AS gd_id, 'file-' || o_orderstatus AS file_path, o_orderkey % 1000 AS lineno, 'rec' || CAST(o_custkey AS STRING) AS record_id FROM {orders}"

ATTRS = f"""
SELECT o_orderkey AS gd_id, 'oclc' AS attr, '035a' AS marc_field, CAST(o_custkey AS STRING) || '|' || {_PRIO} || '|' || o_orderstatus AS str FROM {{orders}}
UNION ALL SELECT o_orderkey, 'sudoc', '086a', {_DAY} || '|' || {_PRIO} || '|' || o_orderstatus FROM {{orders}}
UNION ALL SELECT o_orderkey, 'lccn', '010a', 'l' || CAST(o_custkey AS STRING) || '|' || {_DAY} FROM {{orders}} WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT o_orderkey, 'issn', '022a', CASE WHEN year(o_orderdate) = 1997 THEN '1' ELSE 'i' || CAST(o_orderkey AS STRING) END FROM {{orders}} WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'title', '245a', '  report   ' || CAST(year(o_orderdate) AS STRING) || ' ' || o_orderpriority || ' ' FROM {{orders}}
UNION ALL SELECT o_orderkey, 'pubdate', '260c', CAST(year(o_orderdate) AS STRING) FROM {{orders}}
UNION ALL SELECT o_orderkey, 'publisher', '260b', {pick(PUBLISHERS, "o_custkey")} FROM {{orders}} WHERE o_orderpriority <> '5-LOW'
UNION ALL SELECT DISTINCT l_orderkey, 'enumc', '974z', 'v.' || CAST(l_linenumber AS STRING) FROM {{lineitem}} WHERE l_returnflag <> 'N'
"""

#: Attribute rows with spaces folded, as they are indexed.
CLEAN = f"""
SELECT gd_id, attr, marc_field, substr(trim(regexp_replace(str, ' +', ' '@all)), 1, 750) AS str FROM ({ATTRS}) q WHERE NOT (attr = 'issn' AND str = '1')
"""

TITLES = """
SELECT p_partkey AS gd_id, 'title' AS attr, '245a' AS marc_field, p_name || ' ' || lower(p_brand) AS str FROM {part}
UNION ALL SELECT p_partkey, 'publisher', '260b', lower(p_type) || ' press' FROM {part}
"""

DUMP = f"""
SELECT 'h' || CAST(p_partkey AS STRING) AS htid, CAST(p_partkey % 50 AS STRING) AS record_id, CASE WHEN p_size % 2 = 0 THEN 'v.' || CAST(p_size AS STRING) ELSE '' END AS enum_chron,
  {pick(IMPRINTS, "p_partkey + p_size")} AS imprint, CAST(p_size % 3 AS STRING) AS gov_doc, CAST(1900 + p_partkey % 100 AS STRING) AS pubdate, p_name || ' ' || CAST(1900 + p_size % 100 AS STRING) AS title FROM {{part}}
"""

AGENCIES = f"""
SELECT s_suppkey AS id, {pick(SUDOCS, "s_suppkey")} AS sudoc, {pick(PUBLISHERS, "s_suppkey * 7 + s_nationkey")} AS agency, {pick(PUBLISHERS, "s_suppkey + 3")} AS agency2 FROM {{supplier}}
"""

VOLUMES = "SELECT DISTINCT l_partkey AS volume_id, l_suppkey AS oclc FROM {lineitem}"

_NAMES = re.compile(r"\{(\w+)\}")


def for_spark(sql: str) -> str:
    return sql.replace("@all", "")


def for_duckdb(sql: str) -> str:
    return _NAMES.sub(r"\1", sql.replace("@all", ", 'g'"))


def view(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """A view bound to the tables of a folder, or to frames that are given for them."""
    tables = {t: given[t] if t in given else spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_NAMES.findall(sql))}
    return spark.sql(for_spark(sql), **tables)
