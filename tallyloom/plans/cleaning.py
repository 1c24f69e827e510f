"""Queries on projection, filters, casts and repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import arrays, numbers, text
from tallyloom.operators import clean
from tallyloom.plans.registry import Tables, query

c = F.col


@query("project_cols", "SELECT c_name, c_mktsegment FROM customer")
def project_cols(t: Tables) -> DataFrame:
    return clean.project(t.customer, ["c_name", "c_mktsegment"])


@query("filter_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000")
def filter_range(t: Tables) -> DataFrame:
    return t.orders.where(numbers.in_range(c("o_totalprice"), 100000, 200000)).select("o_orderkey", "o_totalprice")


@query("filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filter_eq(t: Tables) -> DataFrame:
    return t.customer.where(numbers.equals(c("c_mktsegment"), "MACHINERY")).select("c_custkey", "c_name")


@query(
    "filter_divisible",
    """SELECT o_orderkey, o_orderkey % 2 = 0 AS even, o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 AS by_3_and_5
       FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 11 = 0""",
)
def filter_divisible(t: Tables) -> DataFrame:
    k = c("o_orderkey")
    return t.orders.where(numbers.divisible(k, 7, 11)).select(
        "o_orderkey", numbers.divisible(k, 2).alias("even"), numbers.divisible(k, 3, 5).alias("by_3_and_5")
    )


@query(
    "filter_truthy",
    """SELECT 'number' AS kind, count(*) AS n FROM lineitem WHERE l_discount <> 0
       UNION ALL SELECT 'text', count(*) FROM documents WHERE text <> ''
       UNION ALL SELECT 'array', count(*) FROM embeddings WHERE len(embedding) > 0
       UNION ALL SELECT 'null', 0""",
)
def filter_truthy(t: Tables) -> DataFrame:
    def left(df: DataFrame, col: str, kind: str) -> DataFrame:
        return clean.drop_falsy(df, col).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")

    nothing = t.orders.select(F.lit(None).cast("int").alias("v"))
    frames = [(t.lineitem, "l_discount", "number"), (t.documents, "text", "text"), (t.embeddings, "embedding", "array")]
    counted = left(nothing, "v", "null")
    for df, col, kind in frames:
        counted = counted.unionByName(left(df, col, kind))
    return counted


@query(
    "predicate_factory",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity BETWEEN 10 AND 20 AND l_discount > 0.05 AND l_linenumber <> 3""",
)
def predicate_factory(t: Tables) -> DataFrame:
    middle, deep = numbers.range_filter(10, 20), numbers.threshold_filter(0.05, ">")
    other = numbers.threshold_filter(3, "!=")
    keep = middle(c("l_quantity")) & deep(c("l_discount")) & other(c("l_linenumber"))
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "case_bucket",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 250000 THEN 'middle' ELSE 'high' END
       AS bucket FROM orders""",
)
def case_bucket(t: Tables) -> DataFrame:
    price = c("o_totalprice")
    bucket = numbers.case_bucket([(price < 50000, "low"), (price < 250000, "middle")], "high")
    return t.orders.select("o_orderkey", bucket.alias("bucket"))


_PRIMES = """sieve AS (SELECT o_orderkey AS n FROM orders WHERE o_orderkey > 1 AND NOT EXISTS (
  SELECT 1 FROM range(2, 2000) d(d) WHERE d.d * d.d <= o_orderkey AND o_orderkey % d.d = 0))"""


@query("prime_filter", f"WITH {_PRIMES} SELECT n AS o_orderkey FROM sieve")
def prime_filter(t: Tables) -> DataFrame:
    return t.orders.where(numbers.is_prime(c("o_orderkey"))).select("o_orderkey")


@query(
    "prime_count",
    f"""WITH {_PRIMES} SELECT o_orderpriority, count(n) AS primes, count(*) AS rows
        FROM orders LEFT JOIN sieve ON n = o_orderkey GROUP BY o_orderpriority""",
)
def prime_count(t: Tables) -> DataFrame:
    found = F.count_if(numbers.is_prime(c("o_orderkey")))
    return t.orders.groupBy("o_orderpriority").agg(found.alias("primes"), F.count("*").alias("rows"))


@query(
    "derived_arith",
    """SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) * l_linenumber AS square,
         CAST(l_linenumber AS BIGINT) * l_linenumber * l_linenumber AS cube, round(l_quantity * l_extendedprice, 2) AS product,
         l_orderkey + 2 * l_partkey + 3 * l_suppkey AS weighted FROM lineitem""",
)
def derived_arith(t: Tables) -> DataFrame:
    n = c("l_linenumber")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.power(n, 2).alias("square"),
        numbers.power(n, 3).alias("cube"),
        F.round(c("l_quantity") * c("l_extendedprice"), 2).alias("product"),
        numbers.weighted_sum(c("l_orderkey"), c("l_partkey"), c("l_suppkey")).alias("weighted"),
    )


@query(
    "discount",
    """SELECT p_partkey, round(p_retailprice * 0.9, 4) AS all_ten,
         round(CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 0.85 ELSE p_retailprice END, 4) AS economy_fifteen FROM part""",
)
def discount(t: Tables) -> DataFrame:
    price = c("p_retailprice")
    return t.part.select(
        "p_partkey",
        F.round(numbers.discount(price, 10), 4).alias("all_ten"),
        F.round(numbers.discount(price, 15, c("p_type") == "ECONOMY"), 4).alias("economy_fifteen"),
    )


@query(
    "cast_cols",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
         CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal FROM customer""",
)
def cast_cols(t: Tables) -> DataFrame:
    types = {"c_custkey": "string", "c_nationkey": "long", "c_acctbal": "long"}
    return clean.cast_cols(t.customer.select(*types), types)


@query(
    "coerce_numeric",
    """SELECT n_nationkey, CASE WHEN n_name = 'NATION_3' THEN NULL ELSE n_regionkey END AS v FROM nation
       UNION ALL SELECT CAST(c_custkey AS INTEGER), NULL FROM customer""",
)
def coerce_numeric(t: Tables) -> DataFrame:
    mixed = F.when(c("n_name") == "NATION_3", "three").otherwise(c("n_regionkey").cast("string"))
    rows = t.nation.select("n_nationkey", mixed.alias("v")).union(t.customer.select(c("c_custkey").cast("int"), "c_name"))
    return clean.coerce_cols(rows, {"v": "int"})


_HOLES = "holes AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value, NULLIF(user_id, 7) AS user_id FROM events)"


def _holes(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.when(c("event_type") != "error", c("value")).alias("value"), F.nullif("user_id", F.lit(7)).alias("user_id")
    )


@query(
    "null_counts",
    f"""WITH {_HOLES} SELECT 'event_id' AS "column", count(*) - count(event_id) AS nulls FROM holes
        UNION ALL SELECT 'value', count(*) - count(value) FROM holes
        UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM holes""",
)
def null_counts(t: Tables) -> DataFrame:
    return clean.null_counts(_holes(t))


@query(
    "fill_median",
    f"""WITH {_HOLES} SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM holes)), 4) AS value,
          coalesce(user_id, -1) AS user_id FROM holes""",
)
def fill_median(t: Tables) -> DataFrame:
    filled = clean.fill_const(clean.fill_median(_holes(t), "value"), {"user_id": -1})
    return filled.withColumn("value", F.round("value", 4))


@query(
    "validation_report",
    """SELECT count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS negative_year, count(*) FILTER (c_acctbal > 9000) AS future_year,
         count(*) FILTER (c_mktsegment IS NULL OR trim(c_mktsegment) = '') AS blank_name FROM customer""",
)
def validation_report(t: Tables) -> DataFrame:
    return clean.validation_report(t.customer, c("c_acctbal"), c("c_mktsegment"), today=9000)


_DECADES = "(CAST(floor((year(o_orderdate) - 1000) / 10) AS BIGINT) * 10) || 's'"


@query(
    "decade_counts",
    f"SELECT {_DECADES} AS decade, count(*) AS n FROM orders GROUP BY 1",
)
def decade_counts(t: Tables) -> DataFrame:
    return clean.decade_counts(t.orders, F.year("o_orderdate") - 1000)


@query("top_decade", f"SELECT {_DECADES} AS decade, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, decade LIMIT 1")
def top_decade(t: Tables) -> DataFrame:
    return clean.top_decade(t.orders, F.year("o_orderdate") - 1000)


@query("rename_col", "SELECT n_nationkey AS id, n_name AS label, n_regionkey FROM nation")
def rename_col(t: Tables) -> DataFrame:
    return clean.rename(t.nation, {"n_nationkey": "id", "n_name": "label"})


@query(
    "map_ops",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'user' WHEN event_type < 'user' THEN event_type || ',user'
           ELSE 'user,' || event_type END AS dropped_click_keys,
         CASE WHEN event_type < 'user' THEN event_type || ',user' ELSE 'user,' || event_type END AS keys,
         CAST(2 AS INTEGER) AS size, CAST(0 AS DOUBLE) AS user_value FROM events""",
)
def map_ops(t: Tables) -> DataFrame:
    start = F.create_map(c("event_type"), c("value"), F.lit("user"), c("user_id").cast("double"))
    put = arrays.map_put(start, F.lit("user"), F.lit(0.0))
    m = t.events.select("event_id", put.alias("m"))
    return m.select(
        "event_id",
        F.array_join(arrays.map_sorted_keys(arrays.map_drop(c("m"), F.lit("click"))), ",").alias("dropped_click_keys"),
        F.array_join(arrays.map_sorted_keys(c("m")), ",").alias("keys"),
        F.size("m").alias("size"),
        c("m")["user"].alias("user_value"),
    )


@query(
    "map_items",
    """SELECT event_id, CASE WHEN event_type < 'user' THEN event_type || '=' || k || ',user=' || user_id
         ELSE 'user=' || user_id || ',' || event_type || '=' || k END AS items
       FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""",
)
def map_items(t: Tables) -> DataFrame:
    number = F.from_json("props", "k long")["k"]
    held = F.create_map(c("event_type"), number, F.lit("user"), c("user_id"))
    shown = F.transform(arrays.map_items(held), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return t.events.select("event_id", F.array_join(shown, ",").alias("items"))


@query(
    "clean_steps",
    """SELECT c_mktsegment AS segment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""",
)
def clean_steps(t: Tables) -> DataFrame:
    steps = clean.compose(
        lambda df: clean.rename(df, {"c_mktsegment": "segment"}),
        lambda df: df.where(numbers.threshold_filter(0)(c("c_acctbal"))),
        lambda df: df.groupBy("segment").agg(F.count("*").alias("n")),
    )
    return steps(t.customer)


@query(
    "record_filters",
    """SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 1000 AND c_mktsegment <> 'MACHINERY' AND length(c_mktsegment) > 8
         AND regexp_matches(lower(c_mktsegment), '^[aeiou]')
       UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE length(s_name) > 10 AND s_acctbal > 5000""",
)
def record_filters(t: Tables) -> DataFrame:
    segment = c("c_mktsegment")
    keep = (c("c_acctbal") > 1000) & (segment != "MACHINERY") & text.longer_than(segment, 8) & text.starts_with_vowel(segment)
    suppliers = t.supplier.where(text.longer_than(c("s_name"), 10) & (c("s_acctbal") > 5000)).select("s_suppkey", "s_name")
    return t.customer.where(keep).select("c_custkey", "c_name").union(suppliers)


@query(
    "century",
    "SELECT o_orderkey, CAST(floor((1000 + o_orderkey % 1100) / 100) AS BIGINT) + 1 AS century FROM orders",
)
def century(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", numbers.century(1000 + c("o_orderkey") % 1100).alias("century"))


@query(
    "text_compose",
    "SELECT p_partkey, upper(trim(p_name)) || '!' AS loud FROM part",
)
def text_compose(t: Tables) -> DataFrame:
    loud = clean.compose_columns(F.trim, F.upper, lambda x: text.concat_text(x, F.lit("!")))
    return t.part.select("p_partkey", loud(c("p_name")).alias("loud"))
