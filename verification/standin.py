"""The five input tables, stood in for by the driver's TPC-H-like tables.

Plain SQL that Spark and DuckDB both accept: client = part type, service type = ten part numbers, account
= customer, visit and subscription = line item, so that types and accounts grow with the scale factor.
A customer's visits are of three neighbouring parts. The source data is clean; the CASE arms add NULLs,
malformed numbers, dates in several spellings and accounting text deterministically.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from catalog_signals import Params
from catalog_signals.config import HAS_RESERVICE, RECURRING, RESERVICE, ZERO_TIME

AS_OF = "2003-10-15 12:00:00"

#: A logical client over two source clients.
ALIASES = {"COMPACT": ["SMALL", "MEDIUM"]}

#: Keywords for two-word descriptions; "old" also hits "cold".
KEYWORDS = {
    RESERVICE: ("hot",),
    RECURRING: ("ring", "rod"),
    ZERO_TIME: ("old", "bolt"),
    HAS_RESERVICE: ("gear", "red"),
}
PARAMS = Params(keywords=KEYWORDS)

VIEWS = {
    "service_type_raw": """
        SELECT CASE WHEN p_partkey % 101 = 7 THEN NULL ELSE p_type END AS CLIENT,
               CAST(CAST(floor(p_partkey / 10) AS BIGINT) AS STRING) AS TYPE_ID,
               CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE p_name END AS DESCRIPTION,
               CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 13 = 0 THEN NULL
                    ELSE CAST(p_partkey % 3 AS STRING) END AS RESERVICE,
               CAST(p_partkey % 2 AS STRING) AS REGULAR_SERVICE,
               CASE WHEN p_partkey % 17 = 0 THEN '1x' ELSE CAST(p_size % 4 * 30 AS STRING) END AS FREQUENCY,
               CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_size % 3 * 15 AS STRING) END AS DEFAULT_LENGTH,
               CAST(p_partkey % 7 AS STRING) AS INITIAL_ID,
               CASE WHEN p_partkey % 5 = 0 THEN '1' ELSE '0' END AS INITIAL,
               DATE '2000-01-01' + CAST(p_partkey AS INT) AS DATE_LOADED
        FROM part
    """,
    "merged_service_type": """
        SELECT TYPE_ID AS typeID, CLIENT AS clientID,
               CASE WHEN CAST(TYPE_ID AS INT) % 7 = 0 THEN DESCRIPTION || ' (old)' ELSE DESCRIPTION END AS description
        FROM (SELECT *, row_number() OVER (PARTITION BY CLIENT, TYPE_ID ORDER BY DATE_LOADED DESC) AS rn FROM service_type_raw) v
        WHERE rn = 1 AND CAST(TYPE_ID AS INT) % 9 <> 0
    """,
    "recurring_lookup": """
        SELECT DISTINCT p_type AS clientId, p_name AS serviceType,
               CASE length(p_name) % 4 WHEN 0 THEN ' true ' WHEN 1 THEN 'FALSE' WHEN 2 THEN '' ELSE NULL END AS isRecurring
        FROM part
        UNION ALL
        SELECT DISTINCT p_type, p_name, 'TRUE' FROM part WHERE p_name LIKE 'hot %'
        UNION ALL
        SELECT DISTINCT p_type, p_name, 'unknown' FROM part WHERE p_name LIKE '%gear'
    """,
    "appointments": """
        SELECT CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE o_custkey END AS individualAccountID,
               CASE WHEN l_orderkey % 97 = 0 THEN 'unknown' WHEN l_orderkey % 89 = 0 THEN type_id || '.0'
                    ELSE type_id END AS type,
               CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_orderkey % 59 = 0 THEN 'soon'
                    WHEN l_orderkey % 7 = 1 THEN substr(day, 6, 2) || '/' || substr(day, 9, 2) || '/' || substr(day, 1, 4)
                    WHEN l_orderkey % 7 = 2 THEN substr(day, 1, 4) || substr(day, 6, 2) || substr(day, 9, 2)
                    WHEN l_orderkey % 7 = 3
                    THEN substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr(day, 6, 2) AS INT) - 2, 3)
                         || ' ' || substr(day, 9, 2) || ', ' || substr(day, 1, 4)
                    ELSE day END AS appointmentDate,
               p_type AS clientID, l_extendedprice AS productionValue
        FROM (SELECT *, CAST(l_shipdate AS STRING) AS day FROM lineitem) l
        JOIN orders ON l_orderkey = o_orderkey
        JOIN (SELECT *, CAST(CAST(floor(p_partkey / 10) AS BIGINT) AS STRING) AS type_id FROM part) p ON p_partkey = o_custkey + l_linenumber % 3
    """,
    "subscriptions": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS subscriptionID, 
               CAST(CAST(floor(p_partkey / 10) AS BIGINT) AS STRING) AS serviceID, p_name AS serviceType,
               CASE WHEN l_orderkey % 1009 = 5 THEN '1e22' WHEN l_orderkey % 1009 = 6 THEN '1e400'
                    WHEN l_orderkey % 1009 = 7 THEN '$99999999999999999999999'
                    WHEN l_suppkey % 19 = 0 THEN 'n/a' WHEN l_suppkey % 7 = 0 THEN concat('($', amt, ')')
                    WHEN l_suppkey % 5 = 0 THEN concat(' ', amt, ' ') ELSE concat('$', amt) END AS annualRecurringServices,
               l_returnflag = 'N' AND p_partkey % 30 < 20 AS active,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate ELSE NULL END AS dateCancelled,
               p_type AS clientID, l_shipdate AS dateAdded
        FROM (SELECT *, CASE WHEN length(raw) > 6
                             THEN concat(substr(raw, 1, length(raw) - 6), ',', substr(raw, length(raw) - 5)) ELSE raw END AS amt
              FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS STRING) AS raw
                    FROM lineitem) a) b
        JOIN part ON l_partkey = p_partkey
    """,
}

_SOURCES = {
    "service_type_raw": ["part"],
    "merged_service_type": ["part"],
    "recurring_lookup": ["part"],
    "appointments": ["lineitem", "orders", "part"],
    "subscriptions": ["lineitem", "part"],
}


#: Keys by which the large tables of a view are dealt for their join, and tasks of it for every shuffle partition of
#: the session: adaptive execution leaves a given number alone, and so few tasks don't sort very many rows each.
_DEALT = {"appointments": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}
_SPREAD = 4


_schemas: dict[str, T.StructType] = {}


def open_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def stand_in(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    sources = {t: open_table(spark, sf_dir, t) for t in _SOURCES[view]}
    n = _SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for t, key in _DEALT.get(view, {}).items():
        sources[t] = sources[t].repartition(n, key)
    ctes = [f"{t} AS (SELECT * FROM {{{t}}})" for t in sources]
    if view == "merged_service_type":
        ctes.append(f"service_type_raw AS ({VIEWS['service_type_raw']})")
    return spark.sql(f"WITH {', '.join(ctes)} {VIEWS[view]}", **sources)


class StandInTables:
    """The inputs of ``CatalogTables``, each opened when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._open = lambda view: stand_in(spark, sf_dir, view)

    service_types = cached_property(lambda self: self._open("service_type_raw"))
    merged_service_types = cached_property(lambda self: self._open("merged_service_type"))
    visits = cached_property(lambda self: self._open("appointments"))
    subscriptions = cached_property(lambda self: self._open("subscriptions"))
    lookup = cached_property(lambda self: self._open("recurring_lookup"))
