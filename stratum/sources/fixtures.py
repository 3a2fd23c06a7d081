"""Raw, deliberately dirty inputs derived from the shared test tables.

The source pipeline ships no data, so its three inputs are derived from the
read-only test tables by portable SQL (one text, run by Spark here and by
DuckDB in the oracle), injecting every kind of dirt the rules look for.
``_seq`` is the arrival order the deterministic batch dedup uses.  Amounts are
multiples of 0.25, so double sums are exact in any order.

``{events}`` / ``{supplier}`` / ``{customer}`` are placeholders: Spark binds
DataFrames through ``spark.sql(text, events=df)``; the oracle substitutes the
view names.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RAW_TRANSACTIONS_SQL = """
WITH b AS (SELECT event_id e, user_id u, event_type t, substr(cast(ts AS string),1,10) d,
                  cast(floor(value*1000) AS bigint) i FROM {events}),
c AS (SELECT e AS _seq,
 CASE WHEN e%211=0 THEN NULL WHEN e%97=0 THEN concat('TX-',e)
      ELSE concat('TXN-',replace(d,'-',''),'-',lpad(cast(e%100000 AS string),5,'0')) END AS transaction_id,
 CASE WHEN e%223=0 THEN NULL WHEN e%101=0 THEN concat('U',u)
      ELSE concat('USR-',lpad(cast(u AS string),6,'0')) END AS user_id,
 CASE WHEN e%227=0 THEN NULL WHEN e%103=0 THEN 'M1'
      ELSE concat('MCH-',lpad(cast(u%20 AS string),5,'0')) END AS merchant_id,
 CASE WHEN e%229=0 THEN 'abc' WHEN e%107=0 THEN '-5.00'
      WHEN e%3=0 THEN concat(cast(cast(floor(i/1000) AS bigint) AS string),'.',lpad(cast(i%1000 AS string),3,'0'),',50')
      WHEN e%3=1 THEN concat(cast(i AS string),',75') ELSE concat(cast(i AS string),'.25') END AS amount,
 CASE WHEN e%109=0 THEN 'transfer' WHEN e%233=0 THEN NULL WHEN t='error' THEN 'Reversa'
      WHEN t='signup' THEN ' retiro' WHEN t='click' THEN 'PAYMENT' ELSE ' Pago ' END AS transaction_type,
 CASE WHEN e%113=0 THEN 'fax' WHEN e%3=0 THEN 'WEB' WHEN e%3=1 THEN ' app' ELSE 'pos' END AS channel,
 CASE WHEN e%127=0 THEN 'unknown' WHEN e%7=0 THEN 'Rechazado' WHEN e%7=1 THEN 'pendiente ' ELSE 'APROBADO' END AS status,
 CASE WHEN e%131=0 THEN 'EUR' WHEN e%4=0 THEN 'sol' WHEN e%4=1 THEN 'Soles' WHEN e%4=2 THEN 'us$' ELSE ' pen ' END AS currency,
 CASE WHEN e%137=0 THEN '2024-02-30' WHEN e%2=0 THEN d
      ELSE concat(substr(d,9,2),'/',substr(d,6,2),'/',substr(d,1,4)) END AS transaction_date,
 CASE WHEN e%139=0 THEN CASE WHEN t='error' THEN NULL ELSE 'TXN-X' END
      WHEN t='error' THEN concat('TXN-REF-',e) ELSE NULL END AS reference_id
 FROM b)
SELECT * FROM c
UNION ALL
SELECT _seq+1000000000, transaction_id, user_id, merchant_id, '999.00', transaction_type, channel, status,
       currency, transaction_date, reference_id FROM c WHERE _seq%50=0
"""

RAW_MERCHANTS_SQL = """
WITH b AS (SELECT s_suppkey k, s_nationkey n FROM {supplier}),
c AS (SELECT k AS _seq,
 CASE WHEN k%31=30 THEN NULL WHEN k%29=28 THEN concat('M-',k) ELSE concat('MCH-',lpad(cast(k AS string),5,'0')) END AS merchant_id,
 CASE WHEN k%37=36 THEN '   ' WHEN k%41=40 THEN NULL ELSE concat('Merchant ',k) END AS merchant_name,
 CASE WHEN k%23=22 THEN 'casino' WHEN k%5=0 THEN ' Retail' WHEN k%5=1 THEN 'FARMACIA' WHEN k%5=2 THEN 'salud '
      WHEN k%5=3 THEN 'Moda' ELSE 'tecnologia' END AS category,
 CASE WHEN k%19=18 THEN 'BRASIL' WHEN n%6=0 THEN 'Peru' WHEN n%6=1 THEN 'COL' WHEN n%6=2 THEN ' mexico '
      WHEN n%6=3 THEN 'chi' WHEN n%6=4 THEN 'AR' ELSE 'pe' END AS country,
 CASE WHEN k%17=16 THEN '31-12-2023' WHEN k%2=0 THEN '2023-05-17' ELSE '17/05/2023' END AS affiliation_date,
 CASE WHEN k%43=42 THEN 'closed' WHEN k%3=0 THEN 'SUSPENDED' WHEN k%3=1 THEN 'Activo' ELSE ' inactivo' END AS status,
 CASE WHEN k%13=12 THEN 'extremo' WHEN k%4=0 THEN NULL WHEN k%4=1 THEN 'BAJO' WHEN k%4=2 THEN 'medio ' ELSE 'Alto' END AS risk_level
 FROM b)
SELECT * FROM c
UNION ALL
SELECT _seq+1000000000, merchant_id, 'Duplicate', category, country, affiliation_date, status, risk_level
FROM c WHERE _seq%10=3
"""

RAW_USERS_SQL = """
SELECT c_custkey AS _seq,
 CASE WHEN c_custkey%53=0 THEN concat('USR-',lpad(cast(c_custkey AS string),6,'0'),'|',c_name)
      WHEN c_custkey%59=0 THEN concat(c_name,'|a|b|c|d|e|f|g|h')
 ELSE concat(
 CASE WHEN c_custkey%61=0 THEN 'USR-1' ELSE concat(' USR-',lpad(cast(c_custkey AS string),6,'0')) END,'|',c_name,'|',
 CASE WHEN c_custkey%67=0 THEN '12-345' ELSE cast(40000000+c_custkey AS string) END,'|',
 CASE WHEN c_custkey%71=0 THEN 'no-at.example.com' ELSE concat('User.',c_custkey,'@Example.COM ') END,'|',
 CASE WHEN c_custkey%73=0 THEN '+51 ext abc' WHEN c_custkey%79=0 THEN '+51 9' WHEN c_custkey%83=0 THEN '+1 (555) 000-11122'
      WHEN c_nationkey%5=0 THEN concat('+51 999-',lpad(cast(c_custkey AS string),6,'0'))
      WHEN c_nationkey%5=1 THEN concat('56 9 ',lpad(cast(c_custkey AS string),8,'0'))
      WHEN c_nationkey%5=2 THEN concat('57',lpad(cast(c_custkey AS string),10,'0'))
      WHEN c_nationkey%5=3 THEN concat('54.11.',lpad(cast(c_custkey AS string),8,'0'))
      ELSE concat('(52) ',lpad(cast(c_custkey AS string),10,'0')) END,'|',
 CASE WHEN c_custkey%89=0 THEN 'BRASIL' WHEN c_custkey%97=0 THEN 'zz' WHEN c_nationkey%5=0 THEN 'Peru' WHEN c_nationkey%5=1 THEN 'chi'
      WHEN c_nationkey%5=2 THEN ' COLOMBIA ' WHEN c_nationkey%5=3 THEN 'ar' ELSE 'Mex' END,'|',
 CASE WHEN c_custkey%101=0 THEN 'gold' WHEN c_custkey%11=0 THEN '' WHEN c_custkey%3=0 THEN ' Premium'
      WHEN c_custkey%3=1 THEN 'ESTANDAR' ELSE 'nuevo' END,'|',
 CASE WHEN c_custkey%103=0 THEN '2024/01/01' WHEN c_custkey%107=0 THEN '31/02/2024'
      WHEN c_custkey%2=0 THEN '2024-03-15' ELSE '15/03/2024 ' END) END AS value
FROM {customer}
"""

TEMPLATES = {
    "raw_transactions": (RAW_TRANSACTIONS_SQL, ("events",)),
    "raw_merchants": (RAW_MERCHANTS_SQL, ("supplier",)),
    "raw_users": (RAW_USERS_SQL, ("customer",)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, tables = TEMPLATES[name]
    return spark.sql(text, **{t: read_table(spark, sf_dir, t) for t in tables})


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, "raw_transactions")


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, "raw_merchants")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, "raw_users")


def oracle_fixture_sql(name: str) -> str:
    """The same fixture text with DuckDB's pre-registered view names."""
    text, tables = TEMPLATES[name]
    return text.format(**{t: t for t in tables})
