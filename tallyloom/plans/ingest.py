"""Queries on readers, writers and generators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.registry import Tables, query
from tallyloom.session import scratch_path
from tallyloom.sources import files, generate, tables


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_roundtrip(t: Tables) -> DataFrame:
    return files.write_read(t.part, scratch_path(t.spark, "part_csv"), "csv")


@query("csv_untyped", "SELECT CAST(n_nationkey AS VARCHAR) AS _c0, n_name AS _c1, CAST(n_regionkey AS VARCHAR) AS _c2 FROM nation")
def csv_untyped(t: Tables) -> DataFrame:
    return files.write_read(t.nation, scratch_path(t.spark, "nation_csv"), "csv", keep_types=False)


@query("tsv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def tsv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer_tsv")
    files.write_csv(t.customer, path, sep="\t")
    return files.read_table(t.spark, path, t.customer.schema, sep="\t")


@query(
    "csv_missing_fill",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 0.0 WHEN 'view' THEN 0.0 ELSE value END AS value FROM events""",
)
def csv_missing_fill(t: Tables) -> DataFrame:
    holes = F.when(F.col("event_type") == "view", "n/a").when(F.col("event_type") != "error", F.col("value").cast("string"))
    path = scratch_path(t.spark, "events_csv")
    files.write_csv(t.events.select("event_id", holes.alias("value")), path)
    return files.read_table_tolerant(t.spark, path, "event_id long, value double", fill={"value": 0.0})


@query("json_flatten_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events")
def json_flatten_props(t: Tables) -> DataFrame:
    nested = t.events.select("event_id", F.from_json("props", "k long").alias("props"))
    return files.flatten_structs(nested, sep="_")


@query("json_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer_json")
    files.write_json_records(t.customer, path)
    return files.read_json_flat(t.spark, path, t.customer.schema, multi_line=False)


@query(
    "sparql_bindings",
    """SELECT c_custkey, c_name AS name, CAST(c_acctbal AS DOUBLE) AS balance FROM customer
       UNION ALL SELECT c_custkey, c_mktsegment, NULL FROM customer""",
)
def sparql_bindings(t: Tables) -> DataFrame:
    def value(col: str):
        return F.struct(F.col(col).cast("string").alias("value"))

    full = F.struct(value("c_name").alias("name"), value("c_acctbal").alias("balance"))
    short = F.struct(value("c_mktsegment").alias("name"), F.lit(None).cast("struct<value: string>").alias("balance"))
    doc = F.struct(F.struct(F.array(full, short).alias("bindings")).alias("results"))
    raw = t.customer.select("c_custkey", F.to_json(doc).alias("json"))
    return files.result_bindings(raw, "json", {"name": "string", "balance": "double"})


@query(
    "multi_file_union",
    """SELECT CAST(4 AS BIGINT) AS files, count(*) AS lines, CAST(sum(length(c_name)) AS BIGINT) AS chars FROM customer""",
)
def multi_file_union(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "names")
    files.write_lines(t.customer.select("c_name").repartition(4), path)
    lines = files.read_lines(t.spark, path + "/*.txt", with_file=True)
    per_file = lines.groupBy("file").agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))
    return per_file.agg(F.count("*").alias("files"), F.sum("lines").alias("lines"), F.sum("chars").alias("chars"))


@query(
    "clean_many_files",
    """SELECT event_type, count(*) AS n, round(sum(CASE WHEN user_id < 10 THEN 0.0 ELSE value END), 2) AS total
       FROM events GROUP BY event_type""",
)
def clean_many_files(t: Tables) -> DataFrame:
    source, out = scratch_path(t.spark, "raw"), scratch_path(t.spark, "clean")
    dirty = F.when(F.col("user_id") < 10, "missing").otherwise(F.col("value").cast("string"))
    files.write_csv(t.events.select("event_type", dirty.alias("value")).repartition(6), source)
    rows = files.read_table_tolerant(t.spark, source + "/*.csv", "event_type string, value double", {"value": 0.0})
    totals = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return files.write_read(totals, out, "parquet")


@query(
    "text_append",
    """SELECT value, count(*) AS n FROM (SELECT c_mktsegment AS value FROM customer UNION ALL SELECT s_name FROM supplier)
       GROUP BY value""",
)
def text_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines")
    files.write_lines(t.customer.select("c_mktsegment"), path)
    files.write_lines(t.supplier.select("s_name"), path, append=True)
    return files.read_lines(t.spark, path).groupBy("value").agg(F.count("*").alias("n"))


_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("orc_roundtrip", _ORDERS)
def orc_roundtrip(t: Tables) -> DataFrame:
    return files.write_read(t.orders, scratch_path(t.spark, "orders_orc"), "orc")


@query("parquet_roundtrip", _ORDERS)
def parquet_roundtrip(t: Tables) -> DataFrame:
    return files.write_read(t.orders, scratch_path(t.spark, "orders_parquet"), "parquet")


@query("managed_table_count", "SELECT o_orderpriority, 2 * count(*) AS n FROM orders GROUP BY o_orderpriority")
def managed_table_count(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders_table")
    name = "orders_" + path.split("/")[-2].split("-")[-1]
    tables.save_table(t.orders, name, path=path)
    tables.append_table(t.orders, name)
    return t.spark.table(name).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("schema_table")
def schema_table(t: Tables) -> DataFrame:
    return files.describe_schema(t.lineitem)


@query(
    "linspace",
    """WITH b AS (SELECT count(*) AS n, max(o_totalprice) AS hi FROM orders)
       SELECT i AS position, round(i * hi / (n - 1), 4) AS value FROM b, LATERAL (SELECT unnest(range(n)) AS i)""",
)
def linspace(t: Tables) -> DataFrame:
    b = t.orders.agg(F.count("*").alias("n"), F.max("o_totalprice").alias("hi")).first()
    return generate.linspace(t.spark, 0.0, b["hi"], b["n"]).select("position", F.round("value", 4).alias("value"))


@query("random_rows")
def random_rows(t: Tables) -> DataFrame:
    return generate.random_rows(t.spark, t.orders.count(), seed=7, lo=1.0, hi=100.0)


@query(
    "prime_range_count",
    """SELECT count(*) AS primes FROM (SELECT unnest(range(2, (SELECT max(o_custkey) + 1 FROM orders))) AS n) p
       WHERE NOT EXISTS (SELECT 1 FROM range(2, 2000) d(d) WHERE d.d * d.d <= n AND n % d.d = 0)""",
)
def prime_range_count(t: Tables) -> DataFrame:
    return generate.count_primes(t.spark, 0, t.orders.agg(F.max("o_custkey")).first()[0] + 1)
