"""Queries on sorting, ranking and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import arrays
from tallyloom.operators import order
from tallyloom.plans.registry import Tables, query

c = F.col


@query(
    "sort_multi",
    """SELECT p_partkey, row_number() OVER (ORDER BY p_brand, p_retailprice DESC, p_partkey) - 1 AS position FROM part""",
)
def sort_multi(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_brand", "p_retailprice")
    return order.enumerate_rows(rows, [F.asc("p_brand"), F.desc("p_retailprice"), "p_partkey"]).select("p_partkey", "position")


@query(
    "sort_ci",
    """WITH m AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS name FROM part)
       SELECT p_partkey, row_number() OVER (ORDER BY lower(name) DESC, p_partkey) - 1 AS position FROM m""",
)
def sort_ci(t: Tables) -> DataFrame:
    name = F.when(c("p_size") > 25, F.upper("p_name")).otherwise(c("p_name"))
    rows = t.part.select("p_partkey", name.alias("name"))
    return order.enumerate_rows(rows, [order.ci_order("name", desc=True), "p_partkey"]).drop("name")


@query(
    "sort_by_value",
    """WITH w AS (SELECT p_partkey, unnest([p_name, p_brand, p_type]) AS word, unnest([length(p_name), length(p_brand), length(p_type)]) AS n
         FROM part)
       SELECT p_partkey, string_agg(word, '|' ORDER BY n, word) AS ordered FROM w GROUP BY p_partkey""",
)
def sort_by_value(t: Tables) -> DataFrame:
    pairs = F.array(*[F.struct(c(w).alias("word"), F.length(w).alias("n")) for w in ("p_name", "p_brand", "p_type")])
    ordered = F.transform(arrays.sort_pairs(pairs, "n"), lambda p: p["word"])
    return t.part.select("p_partkey", F.array_join(ordered, "|").alias("ordered"))


@query(
    "reverse_array",
    """SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS reversed FROM part""",
)
def reverse_array(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(F.reverse(F.split("p_name", " ")), " ").alias("reversed"))


@query(
    "top_k",
    """SELECT * FROM (SELECT o_orderkey, o_totalprice, 'top' AS side FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
       UNION ALL SELECT * FROM (SELECT o_orderkey, o_totalprice, 'bottom' FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""",
)
def top_k(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    best = order.top_k(rows, [F.desc("o_totalprice"), "o_orderkey"], 10).withColumn("side", F.lit("top"))
    return best.union(order.top_k(rows, ["o_totalprice", "o_orderkey"], 10).withColumn("side", F.lit("bottom")))


@query("top_k_distinct", "SELECT DISTINCT l_quantity FROM lineitem ORDER BY l_quantity DESC LIMIT 5")
def top_k_distinct(t: Tables) -> DataFrame:
    return order.top_k_distinct(t.lineitem, "l_quantity", 5)


@query(
    "offset_rows",
    """SELECT month, n FROM (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY 1)
       ORDER BY n DESC, month OFFSET 3""",
)
def offset_rows(t: Tables) -> DataFrame:
    months = t.orders.groupBy(F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    return order.skip_first(months, [F.desc("n"), "month"], 3)


@query(
    "peak_years",
    """WITH k AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS key, count(*) AS n FROM orders GROUP BY 1),
            p AS (SELECT key FROM k ORDER BY n DESC, key LIMIT 5)
       SELECT key, n, key IN (SELECT key FROM p) AS peak FROM k""",
)
def peak_years(t: Tables) -> DataFrame:
    return order.peak_groups(t.orders, F.year("o_orderdate"), 5)


@query(
    "range_top_groups",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS key, count(*) AS n FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000
       GROUP BY 1 ORDER BY n DESC, key LIMIT 3""",
)
def range_top_groups(t: Tables) -> DataFrame:
    return order.range_top_groups(t.lineitem, F.year("l_shipdate"), 1996, 2000, 3)


@query(
    "consecutive_groups",
    """WITH f AS (SELECT user_id, event_type, ts, event_id, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS new
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
       r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) - 1 AS run FROM f)
       SELECT user_id, run, event_type, count(*) AS n FROM r GROUP BY 1, 2, 3""",
)
def consecutive_groups(t: Tables) -> DataFrame:
    return order.consecutive_groups(t.events, ["user_id"], ["ts", "event_id"], "event_type")


@query(
    "sliding_window",
    """SELECT event_id, CAST(w[1] AS BIGINT) AS a, CAST(w[2] AS BIGINT) AS b, CAST(w[3] AS BIGINT) AS c FROM
         (SELECT event_id, list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS w
          FROM events) WHERE len(w) = 3""",
)
def sliding_window(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "ts", "event_id")
    full = order.sliding_window(rows, ["user_id"], ["ts", "event_id"], "event_id", 3)
    return full.select("event_id", *[c("window")[i].alias(n) for i, n in enumerate("abc")])


@query(
    "batch_ids",
    """SELECT batch, count(*) AS n, min(o_orderkey) AS first FROM
         (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 64) AS BIGINT) AS batch FROM orders)
       GROUP BY batch""",
)
def batch_ids(t: Tables) -> DataFrame:
    batches = order.batch_ids(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 64)
    return batches.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query(
    "first_n_matching",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000 ORDER BY o_orderkey LIMIT 20""",
)
def first_n_matching(t: Tables) -> DataFrame:
    hit = (c("o_orderstatus") == "F") & (c("o_totalprice") > 400000)
    return order.first_n(t.orders, hit, "o_orderkey", 20).select("o_orderkey")


@query(
    "running_sum",
    """SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2) AS running FROM events""",
)
def running_sum(t: Tables) -> DataFrame:
    rows = order.running_sum(t.events, ["user_id"], ["ts", "event_id"], "value")
    return rows.select("event_id", F.round("running", 2).alias("running"))
