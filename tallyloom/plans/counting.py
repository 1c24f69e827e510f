"""Queries on aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import aggregate
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query

c = F.col


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({x: F.round(x, digits) for x in cols})


@query("total_chars", "SELECT CAST(sum(length(text)) AS BIGINT) AS chars FROM documents")
def total_chars(t: Tables) -> DataFrame:
    return aggregate.total_chars(t.documents, "text")


@query(
    "total_tokens",
    """SELECT CAST(sum(len(string_split(text, ','))) AS BIGINT) AS tokens, 'comma' AS sep FROM documents
       UNION ALL SELECT CAST(sum(len(string_split(text, ' '))) AS BIGINT), 'blank' FROM documents""",
)
def total_tokens(t: Tables) -> DataFrame:
    comma = aggregate.total_tokens(t.documents, ",", "text").withColumn("sep", F.lit("comma"))
    return comma.union(aggregate.total_tokens(t.documents, " ", "text").withColumn("sep", F.lit("blank")))


@query("pattern_count", "SELECT CAST(sum(len(regexp_extract_all(text, '[0-9]+'))) AS BIGINT) AS matches FROM documents")
def pattern_count(t: Tables) -> DataFrame:
    return aggregate.pattern_count(t.documents, "[0-9]+", "text")


@query(
    "count_where",
    """SELECT count(*) AS rows, count(*) FILTER (o_orderstatus = 'F') AS hits,
         round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS share FROM orders""",
)
def count_where(t: Tables) -> DataFrame:
    return _rounded(aggregate.count_where(t.orders, c("o_orderstatus") == "F"), 6, "share")


@query("group_size", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def group_size(t: Tables) -> DataFrame:
    return aggregate.group_size(t.orders, [F.year("o_orderdate").alias("year")])


@query(
    "group_count_cols",
    """SELECT event_type, count(event_id) AS event_id, count(NULLIF(user_id, 7)) AS user_id, count(value) AS value
       FROM events GROUP BY event_type""",
)
def group_count_cols(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", "event_id", F.nullif("user_id", F.lit(7)).alias("user_id"), "value")
    return aggregate.group_counts(rows, "event_type")


@query(
    "group_two_keys",
    """SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def group_two_keys(t: Tables) -> DataFrame:
    keys = ["l_returnflag", F.year("l_shipdate").alias("year")]
    return aggregate.group_size(t.lineitem, keys).orderBy("l_returnflag", "year")


@query("value_counts", "SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type")
def value_counts(t: Tables) -> DataFrame:
    return aggregate.value_counts(t.part, "p_type")


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(t: Tables) -> DataFrame:
    return aggregate.distinct_values(t.part, "p_brand")


def _describe_sql(col: str) -> str:
    return f"""SELECT '{col}' AS "column", count({col}) AS count, round(avg({col}), 4) AS mean, round(stddev_samp({col}), 4) AS std,
      min({col}) AS min, round(quantile_cont({col}, 0.25), 4) AS q25, round(quantile_cont({col}, 0.5), 4) AS q50,
      round(quantile_cont({col}, 0.75), 4) AS q75, max({col}) AS max FROM lineitem"""


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe_numeric", " UNION ALL ".join(_describe_sql(x) for x in _MEASURES))
def describe_numeric(t: Tables) -> DataFrame:
    return _rounded(aggregate.describe_numeric(t.lineitem, _MEASURES), 4, "mean", "std", "q25", "q50", "q75")


@query(
    "describe_text",
    """WITH k AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1)
       SELECT CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", (SELECT p_name FROM k ORDER BY n DESC, p_name LIMIT 1) AS top,
         max(n) AS freq FROM k""",
)
def describe_text(t: Tables) -> DataFrame:
    return aggregate.describe_text(t.part, "p_name")


@query(
    "extremes",
    """SELECT * FROM (SELECT o_totalprice AS min_value, o_orderkey AS min_label FROM orders ORDER BY 1, 2 LIMIT 1),
       (SELECT o_totalprice AS max_value, o_orderkey AS max_label FROM orders ORDER BY 1 DESC, 2 LIMIT 1)""",
)
def extremes(t: Tables) -> DataFrame:
    return aggregate.extremes(t.orders, "o_totalprice", "o_orderkey")


@query(
    "fold_aggs",
    """SELECT round(sum(l_quantity), 2) AS total, round(product(1 + l_discount / 1000), 6) AS product, max(l_quantity) AS largest
       FROM lineitem""",
)
def fold_aggs(t: Tables) -> DataFrame:
    folded = aggregate.fold_aggs(t.lineitem, "l_quantity", 1 + c("l_discount") / 1000)
    return _rounded(_rounded(folded, 2, "total"), 6, "product")


@query(
    "inventory_value",
    """SELECT l_returnflag, round(sum(l_quantity * l_extendedprice), 1) AS total FROM lineitem GROUP BY 1
       UNION ALL SELECT 'all', round(sum(l_quantity * l_extendedprice), 1) FROM lineitem""",
)
def inventory_value(t: Tables) -> DataFrame:
    price, qty = c("l_extendedprice"), c("l_quantity")
    everything = aggregate.total_value(t.lineitem, price, qty).select(F.lit("all").alias("l_returnflag"), "total")
    return _rounded(aggregate.total_value(t.lineitem, price, qty, "l_returnflag").union(everything), 1, "total")


_INCOME = "event_type IN ('purchase', 'signup')"


@query(
    "net_balance",
    f"""SELECT user_id, round(coalesce(sum(CASE WHEN {_INCOME} THEN value END), 0), 2) AS income,
         round(coalesce(sum(CASE WHEN NOT {_INCOME} THEN value END), 0), 2) AS expense,
         round(sum(CASE WHEN {_INCOME} THEN value ELSE -value END), 2) AS balance,
         max(CASE WHEN NOT {_INCOME} THEN value END) AS largest_expense FROM events GROUP BY user_id""",
)
def net_balance(t: Tables) -> DataFrame:
    per_user = aggregate.net_balance(t.events, c("event_type").isin("purchase", "signup"), c("value"), ["user_id"])
    return _rounded(per_user, 2, "income", "expense", "balance")


_GRADES = ["l_quantity", "l_discount", "l_tax"]


@query(
    "module_stats",
    " UNION ALL ".join(
        f"SELECT '{g}' AS module, round(avg({g}), 6) AS mean, max({g}) AS best, min({g}) AS worst FROM lineitem" for g in _GRADES
    ),
)
def module_stats(t: Tables) -> DataFrame:
    return _rounded(aggregate.module_stats(t.lineitem, [], _GRADES), 6, "mean")


@query(
    "safe_mean",
    """SELECT round(avg(c_acctbal), 2) AS mean, 'all' AS rows FROM customer UNION ALL SELECT 0.0, 'none'""",
)
def safe_mean(t: Tables) -> DataFrame:
    full = aggregate.safe_mean(t.customer, "c_acctbal").withColumn("rows", F.lit("all"))
    return full.union(aggregate.safe_mean(t.customer.where("c_acctbal > 1e9"), "c_acctbal").withColumn("rows", F.lit("none")))


@query(
    "three_means",
    """SELECT round(avg(p_retailprice), 4) AS arithmetic, round(exp(avg(ln(p_retailprice))), 4) AS geometric,
         round(count(*) / sum(1 / p_retailprice), 4) AS harmonic FROM part""",
)
def three_means(t: Tables) -> DataFrame:
    return _rounded(aggregate.three_means(t.part, "p_retailprice"), 4, "arithmetic", "geometric", "harmonic")


_LATEST = """latest AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 1)"""


def _spending(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("latest_per_key", f"WITH {_LATEST} SELECT * FROM latest")
def latest_per_key(t: Tables) -> DataFrame:
    return aggregate.latest_per_key(_spending(t), "o_custkey", F.year("o_orderdate"), ["o_totalprice", "o_orderkey"])


@query(
    "latest_extremes",
    f"""WITH {_LATEST} SELECT * FROM (SELECT o_totalprice AS min_value, o_custkey AS min_label FROM latest ORDER BY 1, 2 LIMIT 1),
        (SELECT o_totalprice AS max_value, o_custkey AS max_label FROM latest ORDER BY 1 DESC, 2 LIMIT 1)""",
)
def latest_extremes(t: Tables) -> DataFrame:
    ties = ["o_totalprice", "o_orderkey"]
    return aggregate.latest_extremes(_spending(t), "o_custkey", F.year("o_orderdate"), "o_totalprice", ties)


_SOLD = """sold AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, p_name AS subject FROM lineitem
  JOIN part ON l_partkey = p_partkey)"""


def _sold(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.year("l_shipdate").alias("year"), c("l_partkey").alias("p_partkey"))
    return lines.join(t.part.select("p_partkey", c("p_name").alias("subject")), "p_partkey").select("year", "subject")


@query(
    "top_subject_per_year",
    f"""WITH {_SOLD}, k AS (SELECT year, subject, count(*) AS n FROM sold GROUP BY 1, 2),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY n DESC, subject) AS INTEGER) AS rank FROM k)
        SELECT * FROM r WHERE rank <= 1""",
)
def top_subject_per_year(t: Tables) -> DataFrame:
    return aggregate.top_per_group(_sold(t), "year", "subject")


@query("top_subjects", f"WITH {_SOLD} SELECT subject, count(*) AS n FROM sold GROUP BY 1 ORDER BY n DESC, subject LIMIT 10")
def top_subjects(t: Tables) -> DataFrame:
    return aggregate.top_items(_sold(t), "subject", 10)


@query("find_duplicates", "SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1")
def find_duplicates(t: Tables) -> DataFrame:
    return aggregate.find_duplicates(t.part, ["p_brand", "p_type", "p_size"])


_FLAGS = ["A", "N", "R"]


@query(
    "pivot_counts",
    f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, {", ".join(f"count(*) FILTER (l_returnflag = '{f}') AS {f}" for f in _FLAGS)}
        FROM lineitem GROUP BY 1""",
)
def pivot_counts(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.year("l_shipdate").alias("year"), "l_returnflag")
    return aggregate.pivot_counts(rows, "year", "l_returnflag", _FLAGS)


@query("daily_counts", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS n FROM events GROUP BY 1")
def daily_counts(t: Tables) -> DataFrame:
    return aggregate.daily_counts(t.events, c("ts").cast("timestamp")).withColumn("day", c("day").cast("timestamp_ntz"))


_HISTOGRAM = """b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(o_totalprice) AS n FROM orders),
  k AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n FROM orders, b GROUP BY 1)
  SELECT CAST(f.i AS INTEGER) AS bin, round(lo + f.i * ((hi - lo) / 20), 4) AS lo, round(lo + (f.i + 1) * ((hi - lo) / 20), 4) AS hi,
  coalesce(k.n, 0) AS n"""


@query("histogram", f"WITH {_HISTOGRAM} FROM range(20) f(i) LEFT JOIN k ON k.bin = f.i, b")
def histogram(t: Tables) -> DataFrame:
    return _rounded(aggregate.histogram(t.orders, "o_totalprice", 20), 4, "lo", "hi")


@query(
    "histogram_density",
    f"""WITH {_HISTOGRAM}, round(coalesce(k.n, 0) / (b.n * (hi - lo) / 20), 12) AS density
        FROM range(20) f(i) LEFT JOIN k ON k.bin = f.i, b""",
)
def histogram_density(t: Tables) -> DataFrame:
    return _rounded(_rounded(aggregate.histogram(t.orders, "o_totalprice", 20, density=True), 4, "lo", "hi"), 12, "density")


@query(
    "set_popularity",
    """WITH h AS (SELECT DISTINCT user_id, event_type AS element FROM events), n AS (SELECT count(DISTINCT user_id) AS users FROM events)
       SELECT element, count(*) AS n, count(*) = max(users) AS in_all, count(*) = 1 AS in_one FROM h, n GROUP BY element""",
)
def set_popularity(t: Tables) -> DataFrame:
    return aggregate.set_popularity(views.user_hobbies(t), "hobbies")


@query(
    "equal_sets",
    """WITH h AS (SELECT l_partkey % 5000 AS k, l_suppkey % 10 AS hobby FROM lineitem GROUP BY 1, 2),
            s AS (SELECT k, string_agg(CAST(hobby AS VARCHAR), ',' ORDER BY hobby) AS members FROM h GROUP BY 1)
       SELECT members, count(*) AS n FROM s GROUP BY members""",
)
def equal_sets(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy(c("l_partkey") % 5000).agg(F.collect_set((c("l_suppkey") % 10).cast("string")).alias("s"))
    return aggregate.equal_sets(rows, "s")


@query(
    "shared_sets",
    """WITH h AS (SELECT l_partkey % 5000 AS id, l_suppkey % 10 AS hobby FROM lineitem GROUP BY 1, 2),
            s AS (SELECT id, string_agg(CAST(hobby AS VARCHAR), ',' ORDER BY hobby) AS members FROM h GROUP BY 1)
       SELECT id, members, count(*) OVER w AS n, min(id) OVER w AS first FROM s WINDOW w AS (PARTITION BY members)""",
)
def shared_sets(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy((c("l_partkey") % 5000).alias("id")).agg(F.collect_set((c("l_suppkey") % 10).cast("string")).alias("s"))
    return aggregate.rows_by_set(rows, "id", "s").drop("set_key")


_MONTHS = """m AS (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1)"""


@query(
    "monthly_extremes",
    f"""WITH {_MONTHS}, e AS (SELECT * FROM (SELECT 'best' AS kind, month, total FROM m ORDER BY total DESC, month LIMIT 3)
          UNION ALL SELECT * FROM (SELECT 'worst', month, total FROM m ORDER BY total, month LIMIT 3))
        SELECT kind, month, round(total, 2) AS total, round(total - (SELECT avg(total) FROM m), 2) AS above_average FROM e""",
)
def monthly_extremes(t: Tables) -> DataFrame:
    found = aggregate.monthly_extremes(t.orders, F.month("o_orderdate"), c("o_totalprice"), 3)
    return _rounded(found, 2, "total", "above_average")


@query("corr_pair", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def corr_pair(t: Tables) -> DataFrame:
    return _rounded(aggregate.correlation(t.lineitem, c("l_quantity"), c("l_extendedprice")), 6, "corr")


@query(
    "udf_map_reduce",
    "SELECT CAST(sum(len(string_split(text, ','))) AS BIGINT) AS result FROM documents",
)
def udf_map_reduce(t: Tables) -> DataFrame:
    return aggregate.map_reduce(t.documents, "text", lambda s: len(s.split(",")), lambda a, b: a + b)
