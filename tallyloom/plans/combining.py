"""Queries on joins, positions, set algebra and statement patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import arrays
from tallyloom.operators import combine, setops, triples
from tallyloom.operators.order import enumerate_rows, top_k
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query

c = F.col


@query(
    "join_inner",
    """SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(t: Tables) -> DataFrame:
    buyers = t.customer.select(c("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return combine.join_on(t.orders.select("o_orderkey", "o_custkey"), buyers, ["o_custkey"])


def _per_nation(t: Tables) -> tuple[DataFrame, DataFrame]:
    big = t.customer.where("c_acctbal > 9900").groupBy(c("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    sup = t.supplier.groupBy(c("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return big, sup


_PER_NATION = """big AS (SELECT c_nationkey AS nation, count(*) AS customers FROM customer WHERE c_acctbal > 9900 GROUP BY 1),
  sup AS (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier GROUP BY 1)"""


@query(
    "join_outer_fill",
    """WITH o AS (SELECT o_custkey AS k, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            u AS (SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS nation FROM customer WHERE c_acctbal > 0)
       SELECT coalesce(o.k, u.k) AS k, coalesce(orders, 0) AS orders, coalesce(nation, 0) AS nation
       FROM o FULL JOIN u ON o.k = u.k""",
)
def join_outer_fill(t: Tables) -> DataFrame:
    o = t.orders.where("o_orderstatus = 'F'").groupBy(c("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    u = t.customer.where("c_acctbal > 0").select(c("c_custkey").alias("k"), c("c_nationkey").cast("long").alias("nation"))
    return combine.outer_fill(o, u, ["k"])


@query("join_left", f"WITH {_PER_NATION} SELECT big.nation, customers, suppliers FROM big LEFT JOIN sup ON big.nation = sup.nation")
def join_left(t: Tables) -> DataFrame:
    return combine.join_on(*_per_nation(t), ["nation"], "left")


@query("join_right", f"WITH {_PER_NATION} SELECT sup.nation, customers, suppliers FROM big RIGHT JOIN sup ON big.nation = sup.nation")
def join_right(t: Tables) -> DataFrame:
    return combine.join_on(*_per_nation(t), ["nation"], "right")


@query(
    "join_anti",
    """SELECT DISTINCT c_custkey AS k, 'no order' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
       UNION ALL SELECT DISTINCT o_custkey, 'no customer' FROM orders WHERE o_custkey NOT IN
         (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""",
)
def join_anti(t: Tables) -> DataFrame:
    buyers = t.orders.select(c("o_custkey").alias("k"))
    known = t.customer.select(c("c_custkey").alias("k"), "c_nationkey")
    idle = combine.only_in(known, buyers, ["k"]).withColumn("side", F.lit("no order"))
    strange = combine.only_in(buyers, known.where("c_nationkey < 20"), ["k"]).withColumn("side", F.lit("no customer"))
    return idle.union(strange)


@query("join_semi", "SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)")
def join_semi(t: Tables) -> DataFrame:
    a = t.customer.select(c("c_nationkey").alias("nation"))
    return combine.keys_in_both(a, t.supplier.select(c("s_nationkey").alias("nation")), ["nation"])


@query(
    "cross_pairs",
    """WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS "left" FROM part),
            a AS (SELECT p_partkey, unnest([p_brand, p_type]) AS "right" FROM part)
       SELECT w.p_partkey, "left", "right" FROM w JOIN a ON w.p_partkey = a.p_partkey""",
)
def cross_pairs(t: Tables) -> DataFrame:
    pairs = arrays.cross_pairs(F.split("p_name", " "), F.array("p_brand", "p_type"))
    return t.part.select("p_partkey", F.inline(pairs))


@query(
    "zip_rows",
    """SELECT a.position, c_custkey, s_suppkey FROM
         (SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS position, c_custkey FROM customer) a
       JOIN (SELECT row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS position, s_suppkey FROM supplier) b
       ON a.position = b.position""",
)
def zip_rows(t: Tables) -> DataFrame:
    a, b = t.customer.select("c_custkey", "c_acctbal"), t.supplier.select("s_suppkey", "s_acctbal")
    pairs = combine.zip_rows(a, b, [F.desc("c_acctbal"), "c_custkey"], [F.desc("s_acctbal"), "s_suppkey"])
    return pairs.select("position", "c_custkey", "s_suppkey")


@query(
    "zip_arrays",
    """SELECT p_partkey, string_agg(CAST(length(w) + i AS VARCHAR), ',' ORDER BY i) AS sums
       FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')[1:2]) AS w, unnest([1, 2]) AS i FROM part) WHERE w IS NOT NULL
       GROUP BY p_partkey""",
)
def zip_arrays(t: Tables) -> DataFrame:
    words, steps = F.split("p_name", " "), F.array(F.lit(1), F.lit(2))
    sums = arrays.zip_arrays(words, steps, lambda w, i: (F.length(w) + i).cast("string"))
    return t.part.select("p_partkey", F.array_join(sums, ",").alias("sums"))


@query(
    "enumerate_rows",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders",
)
def enumerate_orders(t: Tables) -> DataFrame:
    return enumerate_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], start=1).drop(
        "o_totalprice"
    )


@query(
    "year_summary",
    """WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS a_rows FROM orders GROUP BY 1),
            b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS b_rows FROM lineitem GROUP BY 1)
       SELECT coalesce(a.year, b.year) AS year, coalesce(a_rows, 0) AS a_rows, coalesce(b_rows, 0) AS b_rows
       FROM a FULL JOIN b ON a.year = b.year""",
)
def year_summary(t: Tables) -> DataFrame:
    return combine.year_summary(t.orders, t.lineitem, F.year("o_orderdate"), F.year("l_shipdate"))


@query("set_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union(t: Tables) -> DataFrame:
    a = t.customer.select(c("c_nationkey").alias("nation"))
    return setops.set_union(a, t.supplier.select("s_nationkey"))


def _key_sets(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        t.orders.where("o_orderstatus = 'F'").select(c("o_custkey").alias("k")),
        t.customer.where("c_acctbal > 0").select(c("c_custkey").alias("k")),
        t.orders.where("o_totalprice > 300000").select(c("o_custkey").alias("k")),
    )


_KEY_SETS = """a AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
  b AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0),
  d AS (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 300000)"""


@query("set_intersect", f"WITH {_KEY_SETS} SELECT k FROM a INTERSECT SELECT k FROM b")
def set_intersect(t: Tables) -> DataFrame:
    a, b, _ = _key_sets(t)
    return setops.set_intersect(a, b)


@query(
    "set_difference",
    f"""WITH {_KEY_SETS} SELECT k, 'a' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
        UNION ALL SELECT k, 'b' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""",
)
def set_difference(t: Tables) -> DataFrame:
    a, b, _ = _key_sets(t)
    left = setops.set_difference(a, b).withColumn("side", F.lit("a"))
    return left.union(setops.set_difference(b, a).withColumn("side", F.lit("b")))


@query("set_symdiff", f"WITH {_KEY_SETS} (SELECT k FROM a EXCEPT SELECT k FROM b) UNION (SELECT k FROM b EXCEPT SELECT k FROM a)")
def set_symdiff(t: Tables) -> DataFrame:
    a, b, _ = _key_sets(t)
    return setops.set_symdiff(a, b)


@query(
    "set_superset",
    """SELECT 'orders in customers' AS test, NOT EXISTS (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer) AS superset
       UNION ALL SELECT 'customers in orders', NOT EXISTS (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)""",
)
def set_superset(t: Tables) -> DataFrame:
    o, u = t.orders.select("o_custkey"), t.customer.select("c_custkey")
    first = setops.is_superset(u, o).select(F.lit("orders in customers").alias("test"), "superset")
    return first.union(setops.is_superset(o, u).select(F.lit("customers in orders"), "superset"))


@query("set_nested", f"WITH {_KEY_SETS} (SELECT k FROM a INTERSECT SELECT k FROM b) UNION (SELECT k FROM b EXCEPT SELECT k FROM d)")
def set_nested(t: Tables) -> DataFrame:
    a, b, d = _key_sets(t)
    return setops.set_union(setops.set_intersect(a, b), setops.set_difference(b, d))


@query("union_all", f"WITH {_KEY_SETS} SELECT k FROM a UNION ALL SELECT k FROM b UNION ALL SELECT k FROM d")
def union_all(t: Tables) -> DataFrame:
    return setops.chain(*_key_sets(t))


@query(
    "triples_basic",
    f"""WITH {views.TRIPLES} SELECT t.s, l.o AS label, n.o AS country FROM triples t JOIN triples l ON t.s = l.s AND l.p = 'label'
          AND l.lang = 'en' JOIN triples n ON t.s = n.s AND n.p = 'country'
        WHERE t.p = 'type' AND t.o = 'BUILDING' ORDER BY label, t.s LIMIT 100""",
)
def triples_basic(t: Tables) -> DataFrame:
    found = triples.match_triples(views.triples(t), "BUILDING", {"label": "label", "country": "country"}, "en")
    return top_k(found, ["label", "s"], 100)


@query(
    "triples_qualified",
    f"""WITH {views.TRIPLES}, {views.STATEMENTS} SELECT DISTINCT x.s, value, CAST(year(date) AS INTEGER) AS year FROM statements x
        JOIN triples t ON t.s = x.s AND t.p = 'type' AND t.o = 'MACHINERY' WHERE x.p = 'spend'""",
)
def triples_qualified(t: Tables) -> DataFrame:
    facts = views.statements(t).withColumn("year", F.year("date"))
    return triples.match_statements(views.triples(t), facts, "spend", "year", "MACHINERY")


@query(
    "triples_labels",
    f"""WITH {views.TRIPLES} SELECT t.s, n.o AS country, coalesce(a.o, t.s) AS s_label, coalesce(b.o, n.o) AS country_label
        FROM triples t JOIN triples n ON t.s = n.s AND n.p = 'country'
        LEFT JOIN triples a ON a.s = t.s AND a.p = 'label' AND a.lang = 'en'
        LEFT JOIN triples b ON b.s = n.o AND b.p = 'label' AND b.lang = 'en'
        WHERE t.p = 'type' AND t.o = 'HOUSEHOLD'""",
)
def triples_labels(t: Tables) -> DataFrame:
    facts = views.triples(t)
    found = triples.match_triples(facts, "HOUSEHOLD", {"country": "country"})
    return triples.with_labels(found, facts, ["s", "country"], "en")
