"""Tables derived from the given ones, each as Spark columns and as a SQL common table expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.registry import Tables


def pixels(t: Tables) -> DataFrame:
    """A pixel table of five images; several rows may share a position."""
    return t.lineitem.select(
        (F.col("l_suppkey") % 5).alias("image_id"),
        (F.col("l_orderkey") % 64).alias("x"),
        (F.col("l_partkey") % 64).alias("y"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 256).cast("int").alias("r"),
        ((F.col("l_partkey") * 11 + F.col("l_linenumber") * 5) % 256).cast("int").alias("g"),
        ((F.col("l_suppkey") * 17 + F.col("l_quantity").cast("int") * 3) % 256).cast("int").alias("b"),
    )


PIXELS = """pixels AS (SELECT l_suppkey % 5 AS image_id, l_orderkey % 64 AS x, l_partkey % 64 AS y,
  CAST((l_orderkey*7 + l_linenumber*13) % 256 AS INTEGER) AS r,
  CAST((l_partkey*11 + l_linenumber*5) % 256 AS INTEGER) AS g,
  CAST((l_suppkey*17 + CAST(l_quantity AS INTEGER)*3) % 256 AS INTEGER) AS b FROM lineitem)"""


def triples(t: Tables) -> DataFrame:
    """Statements ``s, p, o, lang`` about customers and nations."""
    none = F.lit(None).cast("string")
    c = F.concat(F.lit("c"), F.col("c_custkey"))
    home = F.concat(F.lit("n"), F.col("c_nationkey"))
    n = F.concat(F.lit("n"), F.col("n_nationkey"))
    en = F.lit("en")

    def rows(df: DataFrame, s, p: str, o, lang) -> DataFrame:
        return df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), lang.alias("lang"))

    return (
        rows(t.customer, c, "type", F.col("c_mktsegment"), none)
        .unionByName(rows(t.customer, c, "country", home, none))
        .unionByName(rows(t.customer, c, "label", F.col("c_name"), en))
        .unionByName(rows(t.nation, n, "label", F.col("n_name"), en))
    )


TRIPLES = """triples AS (
  SELECT 'c' || c_custkey AS s, 'type' AS p, c_mktsegment AS o, CAST(NULL AS VARCHAR) AS lang FROM customer
  UNION ALL SELECT 'c' || c_custkey, 'country', 'n' || c_nationkey, NULL FROM customer
  UNION ALL SELECT 'c' || c_custkey, 'label', c_name, 'en' FROM customer
  UNION ALL SELECT 'n' || n_nationkey, 'label', n_name, 'en' FROM nation)"""


def statements(t: Tables) -> DataFrame:
    """Qualified statements: what a customer spent, and when."""
    return t.orders.select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("s"),
        F.lit("spend").alias("p"),
        F.col("o_orderkey").alias("st"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderdate").alias("date"),
    )


STATEMENTS = """statements AS (SELECT 'c' || o_custkey AS s, 'spend' AS p, o_orderkey AS st,
  o_totalprice AS value, o_orderdate AS date FROM orders)"""


def log_lines(t: Tables) -> DataFrame:
    """``YYYY-MM-DD HH:MM:SS [LEVEL] message`` lines of the events."""
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit(" ["),
        F.upper("event_type"),
        F.lit("] user "),
        F.col("user_id").cast("string"),
    )
    return t.events.select(line.alias("value"))


def user_hobbies(t: Tables) -> DataFrame:
    """The event types each user has, as a set."""
    return t.events.groupBy("user_id").agg(F.collect_set("event_type").alias("hobbies"))


def matrix(t: Tables, key: str) -> DataFrame:
    """``row, col, value`` with 20 rows, taken from a lineitem key."""
    cell = t.lineitem.groupBy((F.col(key) % 20).alias("row"), F.col("l_linenumber").cast("long").alias("col"))
    return cell.agg(F.sum(F.col("l_quantity").cast("long")).alias("value"))


def _matrix_sql(name: str, key: str) -> str:
    return f"""{name} AS (SELECT {key} % 20 AS row, CAST(l_linenumber AS BIGINT) AS col,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value FROM lineitem GROUP BY 1, 2)"""


MATRIX_A = _matrix_sql("a", "l_suppkey")
MATRIX_B = _matrix_sql("b", "l_partkey")


def likes(t: Tables) -> DataFrame:
    """Which user bought which item, once per order line."""
    bought = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item"))
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("user")).join(bought, "o_orderkey").select("user", "item")


LIKES = """likes AS (SELECT o_custkey AS "user", l_partkey AS item FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def items(t: Tables) -> DataFrame:
    """Items with three attributes as text."""
    return t.part.select(
        F.col("p_partkey").alias("item"), "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size")
    )


ITEMS = """items AS (SELECT p_partkey AS item, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part)"""


def wkt(t: Tables) -> DataFrame:
    """Customers with a text point made of whole degrees."""
    point = F.concat(
        F.lit("Point("), (F.col("c_custkey") % 360 - 180).cast("string"), F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(")")
    )
    return t.customer.select("c_custkey", "c_name", point.alias("coordinates"))


WKT = """wkt AS (SELECT c_custkey, c_name, 'Point(' || (c_custkey % 360 - 180) || ' ' || c_nationkey || ')' AS coordinates
  FROM customer)"""

# Four colours used as cluster centres.
CENTRES = [(0, 0, 0), (255, 0, 0), (0, 255, 0), (128, 128, 255)]
CENTRES_SQL = """centres AS (SELECT * FROM (VALUES (0, 0.0, 0.0, 0.0), (1, 255.0, 0.0, 0.0), (2, 0.0, 255.0, 0.0),
  (3, 128.0, 128.0, 255.0)) v(cluster, cr, cg, cb))"""
