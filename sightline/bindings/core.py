"""Binding of operators to the given tables: logical views, the query registry and their SQL counterparts."""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sightline.operators.graph import settled
from sightline.operators.ordered import row_numbers

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

# Logical views over the given tables, in SQL that Spark and the checking engine both read.
VIEWS = {
    "search_daily": """
        SELECT l_returnflag AS site, CAST(l_shipdate AS DATE) AS day, l_partkey AS page, l_suppkey AS query,
               CAST(l_quantity AS BIGINT) AS clicks, CAST(FLOOR(l_extendedprice) AS BIGINT) AS impressions,
               l_linenumber AS position
        FROM lineitem""",
    "behaviour_daily": """
        SELECT CAST(user_id % 3 AS BIGINT) AS site, event_type AS channel, CAST(ts AS DATE) AS day,
               COUNT(*) AS sessions, COUNT(CASE WHEN value > 30 THEN 1 END) AS engaged,
               COUNT(DISTINCT user_id) AS users
        FROM events GROUP BY CAST(user_id % 3 AS BIGINT), event_type, CAST(ts AS DATE)""",
    "visibility_daily": """
        SELECT event_type AS entity, CAST(ts AS DATE) AS day,
               CASE WHEN EXTRACT(DAY FROM CAST(ts AS DATE)) % 7 = 0 THEN NULL
                    ELSE CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / (COUNT(*) * 50000.0E0) END AS visibility,
               CAST(COUNT(CASE WHEN value > 50 THEN 1 END) AS DOUBLE) / COUNT(*) AS sov, COUNT(*) AS mentions
        FROM events GROUP BY event_type, CAST(ts AS DATE)""",
    "business_monthly": """
        SELECT SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS month, COUNT(*) AS leads,
               COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS conversions,
               COUNT(CASE WHEN o_orderpriority <= '3' THEN 1 END) * 2 AS target_leads,
               COUNT(CASE WHEN o_orderpriority <= '2' THEN 1 END) AS target_conversions
        FROM orders GROUP BY SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7)""",
    "revision_log": """
        SELECT o_custkey AS id, o_orderkey AS record, CAST(o_orderdate AS DATE) AS as_of, o_orderstatus AS status,
               CAST(FLOOR(o_totalprice) AS BIGINT) AS value,
               ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS revision
        FROM orders""",
    "reviewed": """
        SELECT COALESCE(site, 'all') AS site, COALESCE(channel, 'all') AS channel,
               SUBSTR(CAST(day AS STRING), 1, 10) AS period, SUM(clicks) AS clicks
        FROM (SELECT l_returnflag AS site, l_linestatus AS channel, CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS day,
                     CAST(l_quantity AS BIGINT) AS clicks FROM lineitem) r
        GROUP BY GROUPING SETS ((site, channel, day), (site, day), (channel, day), (day))""",
}


def revision_log(orders: DataFrame) -> DataFrame:
    """The ``revision_log`` view without a window over the customer, who may hold very many orders.

    It is written once, as the log that it stands for would be.
    """
    rows = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("record"), F.to_date("o_orderdate").alias("as_of"),
                         F.col("o_orderstatus").alias("status"), F.floor("o_totalprice").alias("value"))
    return settled(row_numbers(rows, "as_of", "record", "revision", keys=["id"]), "log")


class Tables:
    """Lazy access to the parquet tables of one data folder and to the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "revision_log":
            self.revision_log = revision_log(self.orders)
            return self.revision_log
        if name in VIEWS:
            return self.sql(VIEWS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """Run SQL in which table names stand for the parquet tables and views."""
        used = {n: getattr(self, n) for n in [*TABLES, *VIEWS] if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)}
        for name in used:
            text = re.sub(rf"\b(FROM|JOIN)(\s+){name}\b", rf"\1\2{{{name}}}", text)
        return self.spark.sql(text, **used)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    """SQL with the views it names put in front as common table expressions."""
    needed = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    if not needed:
        return sql.strip()
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return f"{start}{head},\n{body[len(start):]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name`` with its SQL counterpart."""
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Tables(spark, folder))
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql)
        return build
    return register
