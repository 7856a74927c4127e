"""Movie-shaped tables derived from the test tables.

The text of MOVIES and DETAILS runs in Spark and in DuckDB alike, so both
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MOVIES = """
SELECT o_orderkey AS pos, CAST(year(o_orderdate) AS INT) AS src_year,
  CAST(o_orderkey % 600 + 1 AS STRING) || '. ' || CASE WHEN o_orderkey % 29 = 0 THEN 'N/A'
     WHEN o_orderkey % 31 = 0 THEN '' ELSE ' Order ' || CAST(o_orderkey % 5000 AS STRING) || ' ' END AS Title,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN CAST(year(o_orderdate) AS STRING) || '.0'
     ELSE ' ' || CAST(year(o_orderdate) AS STRING) END AS Year,
  CASE o_orderkey % 11 WHEN 0 THEN '1h 30m' WHEN 1 THEN '30m' WHEN 2 THEN '90 min' WHEN 3 THEN '45 minutes'
     WHEN 4 THEN '2 Hours' WHEN 5 THEN '1:15' WHEN 6 THEN ' 90 ' WHEN 7 THEN '2h' WHEN 8 THEN 'PG-13'
     WHEN 9 THEN NULL ELSE '1h 30min' END AS Duration,
  CASE WHEN o_orderkey % 11 = 8 AND o_custkey % 3 > 0 THEN NULL ELSE CASE o_custkey % 8 WHEN 0 THEN 'PG' WHEN 1 THEN 'R'
     WHEN 2 THEN 'tv-ma ' WHEN 3 THEN 'Approved' WHEN 4 THEN 'NC-17' WHEN 5 THEN 'weird' WHEN 6 THEN 'n/a' END END AS MPA,
  CASE o_orderkey % 12 WHEN 0 THEN '11.5' WHEN 1 THEN '0.2' WHEN 2 THEN 'bad' WHEN 3 THEN NULL WHEN 4 THEN '1.0d'
     ELSE ' ' || CAST(o_orderkey % 10 AS STRING) || '.' || CAST(o_custkey % 10 AS STRING) END AS Rating,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN CAST(o_custkey AS STRING)
     WHEN 3 THEN CAST(o_custkey % 9 + 1 AS STRING) || '.' || CAST(o_orderkey % 100 + 100 AS STRING) || 'k'
     ELSE CAST(o_custkey % 9 + 1 AS STRING) || '.' || CAST(o_orderkey % 10 AS STRING)
          || CASE WHEN o_orderkey % 2 = 0 THEN 'K' ELSE 'M' END END AS Votes,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 130 - 10 AS STRING)
     || CASE WHEN o_orderkey % 2 = 0 THEN '.7' ELSE '' END END AS meta_score,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'https://ex.example/none'
     ELSE 'https://ex.example/title/tt' || lpad(CAST(o_custkey AS STRING), 7, '0') || '/?ref_=sr_' || CAST(o_orderkey AS STRING) END AS link,
  CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'unknown'
     WHEN 2 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING)
     WHEN 3 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
     WHEN 4 THEN 'July ' || CAST(day(o_orderdate) AS STRING) || ', ' || CAST(year(o_orderdate) AS STRING)
     ELSE 'March ' || CAST(year(o_orderdate) AS STRING) END AS release_date,
  CASE o_orderkey % 5 WHEN 0 THEN '[]' WHEN 1 THEN 'plain text' WHEN 2 THEN NULL WHEN 3 THEN ' [''Drama'', ''War''] '
     ELSE '["D''Arcy", ''G' || CAST(o_custkey % 7 AS STRING) || ''']' END AS genres,
  '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || chr(160) AS gross_US_Canada
FROM {orders}
"""

DETAILS = """
SELECT CASE WHEN c_custkey = 1 THEN NULL
     ELSE 'https://ex.example/title/tt' || lpad(CAST(c_custkey AS STRING), 7, '0') || '/' END AS link,
  c_name AS writers, c_mktsegment AS production_company
FROM {customer}
"""


_MONTHS = "January February March April May June July August September October November December".split()
_NAME = "CASE month(o_orderdate) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MONTHS, 1)) + " END"
_Y, _M, _D = (f"CAST({part}(o_orderdate) AS STRING)" for part in ("year", "month", "day"))
_ABBR = f"substr({_NAME}, 1, 3)"

#: A date of each known shape, and of three others, from 23 on.
DATE_TEXTS = (
    f"{_NAME} || ' ' || {_D} || ', ' || {_Y}", f"{_ABBR} || ' ' || {_D} || ', ' || {_Y}", f"{_M} || '/' || {_D} || '/' || {_Y}",
    f"{_Y} || '-' || {_M} || '-' || {_D}", f"{_D} || '-' || {_M} || '-' || {_Y}", f"{_NAME} || ' ' || {_Y}", f"{_ABBR} || ' ' || {_Y}", _Y,
    f"{_D} || ' ' || {_NAME} || ' ' || {_Y}", f"{_D} || ' ' || {_ABBR} || ' ' || {_Y}", f"{_D} || '/' || {_M} || '/' || {_Y}",
    f"{_M} || '-' || {_D} || '-' || {_Y}", f"{_Y} || '/' || {_M} || '/' || {_D}", f"{_Y} || '-' || {_M} || '-' || {_D} || ' 10:20:30'",
    f"{_Y} || '-' || {_M} || '-' || {_D} || 'T10:20:30'", f"{_NAME} || ' ' || {_D} || ' ' || {_Y}", f"{_ABBR} || ' ' || {_D} || ' ' || {_Y}",
    f"{_D} || '-' || {_ABBR} || '-' || {_Y}", f"{_D} || '-' || {_NAME} || '-' || {_Y}", f"{_Y} || '-' || {_M}",
    f"{_Y} || lpad({_M}, 2, '0') || lpad({_D}, 2, '0')", f"{_M} || '/' || {_D} || '/' || substr({_Y}, 3, 2)",
    f"{_Y} || '.' || {_M} || '.' || {_D}",
    f"'in ' || {_NAME} || ' ' || {_Y}", f"'Q1  ' || {_Y}", f"{_D} || '.' || {_M} || '.' || {_Y}",
)

DATES = (
    f"SELECT o_orderkey AS pos, o_orderdate, CAST(o_orderkey % {len(DATE_TEXTS)} AS INT) AS shape, CASE o_orderkey % {len(DATE_TEXTS)} "
    + " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(DATE_TEXTS)) + " END AS text FROM {orders}"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw catalogue row per order; ``pos`` is the order of the rows."""
    return spark.sql(MOVIES, orders=table(spark, sf_dir, "orders"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One details row per customer; one of them has no link."""
    return spark.sql(DETAILS, customer=table(spark, sf_dir, "customer"))
