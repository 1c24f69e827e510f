"""Queries on text, URLs, pages, arrays and Python functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import arrays, colour, numbers, text
from tallyloom.operators import feeds, udfs, words
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query

c = F.col

# The same white space as tallyloom.functions.text.SPACE, in the other engine's notation.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_PUNCT = r"[!-/:-@\[-`{-~]"


def _words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{_SPACE}+'), lambda w: w <> '')"


@query(
    "str_concat",
    "SELECT c_custkey, c_name || ' of nation ' || c_nationkey || ' in ' || c_mktsegment AS label FROM customer",
)
def str_concat(t: Tables) -> DataFrame:
    label = text.concat_text(c("c_name"), F.lit(" of nation "), c("c_nationkey"), F.lit(" in "), c("c_mktsegment"))
    return t.customer.select("c_custkey", label.alias("label"))


@query(
    "str_index",
    """SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, NULLIF(substring(text, 4, 1), '') AS fourth, NULLIF(right(text, 1), '') AS last,
         regexp_matches(text, '^\\p{Lu}') AS capitalised FROM documents""",
)
def str_index(t: Tables) -> DataFrame:
    x = c("text")
    return t.documents.select(
        "doc_id",
        F.length(x).alias("chars"),
        text.char_at(x, 3).alias("fourth"),
        text.char_at(x, -1).alias("last"),
        text.is_capitalised(x).alias("capitalised"),
    )


@query(
    "str_split",
    f"""SELECT doc_id, CAST(len(string_split(text, ',')) AS INTEGER) AS by_comma, CAST(len({_words('text')}) AS INTEGER) AS by_space
        FROM documents""",
)
def str_split(t: Tables) -> DataFrame:
    x = c("text")
    return t.documents.select(
        "doc_id", F.size(text.split_text(x, ",")).alias("by_comma"), F.size(text.split_text(x)).alias("by_space")
    )


@query(
    "text_normalise",
    f"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '{_PUNCT}', '', 'g'), '{_SPACE}+', ' ', 'g')) AS clean
        FROM documents""",
)
def text_normalise(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.normalise_text(c("text")).alias("clean"))


@query(
    "title_case",
    r"""SELECT doc_id, list_aggregate(list_transform(regexp_extract_all(text, '(\p{L}+|[^\p{L}]+)'),
          lambda p: CASE substr(p, 1, 1) WHEN 'ß' THEN 'SS' ELSE upper(substr(p, 1, 1)) END || lower(substr(p, 2))), 'string_agg', '')
          AS title FROM documents""",
)
def title_case(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.title_case(c("text")).alias("title"))


@query(
    "palindromes",
    f"""SELECT doc_id, reverse(text) = text AS whole, len(list_filter({_words('lower(text)')}, lambda w: length(w) >= 3 AND reverse(w) = w)) > 0
          AS has_word FROM documents""",
)
def palindromes(t: Tables) -> DataFrame:
    x = c("text")
    return t.documents.select(
        "doc_id", text.is_palindrome(x).alias("whole"), text.has_palindrome_word(x, 3).alias("has_word")
    )


@query(
    "sentence_filters",
    f"""WITH s AS (SELECT doc_id, text, CAST(len({_words('text')}) AS INTEGER) AS words,
          length(regexp_replace(text, '{_SPACE}', '', 'g')) AS solid FROM documents)
        SELECT doc_id, words, round(solid / words, 6) AS mean_len FROM s
        WHERE words > 5 AND contains(lower(text), 'the') AND solid / words > 4""",
)
def sentence_filters(t: Tables) -> DataFrame:
    x = c("text")
    keep = text.contains_ci(x, "The") & (text.word_count(x) > 5) & (text.mean_word_len(x) > 4)
    return t.documents.where(keep).select(
        "doc_id", text.word_count(x).alias("words"), F.round(text.mean_word_len(x), 6).alias("mean_len")
    )


@query(
    "corpus_stats",
    f"""WITH w AS (SELECT doc_id, length(text) AS l, {_words('lower(text)')} AS words FROM documents)
        SELECT count(*) AS texts, CAST(sum(len(words)) AS BIGINT) AS words, round(avg(len(words)), 6) AS mean_words,
          (SELECT count(DISTINCT x) FROM (SELECT unnest(words) AS x FROM w)) AS unique_words,
          (SELECT doc_id FROM w ORDER BY l DESC, doc_id LIMIT 1) AS longest_id FROM w""",
)
def corpus_stats(t: Tables) -> DataFrame:
    return words.corpus_stats(t.documents, "text", "doc_id").withColumn("mean_words", F.round("mean_words", 6))


@query(
    "word_freq_top",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({_words('lower(text)')}) AS word FROM documents)
        GROUP BY word ORDER BY n DESC, word LIMIT 10""",
)
def word_freq_top(t: Tables) -> DataFrame:
    return words.word_freq(t.documents, "text", 10)


@query(
    "string_folds",
    """SELECT conv_id, string_agg(role || ':' || length(text), ' ' ORDER BY turn) AS joined FROM conversations GROUP BY conv_id""",
)
def string_folds(t: Tables) -> DataFrame:
    turns = t.conversations.select("conv_id", "turn", F.concat("role", F.lit(":"), F.length("text")).alias("said"))
    return words.join_rows(turns, ["conv_id"], "said", " ", "turn")


@query(
    "longest_text",
    "SELECT doc_id AS id, CAST(length(text) AS INTEGER) AS length FROM documents ORDER BY length(text) DESC, doc_id LIMIT 1",
)
def longest_text(t: Tables) -> DataFrame:
    return words.longest(t.documents, "text", "doc_id")


@query(
    "flatten_nested",
    """SELECT p_partkey, p_name || ',' || p_brand || ',' || p_type || ',' || p_size AS flat FROM part""",
)
def flatten_nested(t: Tables) -> DataFrame:
    nested = F.array(F.array(F.array("p_name", "p_brand"), F.array("p_type")), F.array(F.array(c("p_size").cast("string"))))
    return t.part.select("p_partkey", F.array_join(arrays.flatten3(nested), ",").alias("flat"))


@query(
    "path_parts",
    r"""SELECT page_id, regexp_extract(split_part(url, '?', 1), '\.([^./]+)$', 1) AS ext,
          regexp_replace(string_split(split_part(url, '?', 1), '/')[-1], '\.[^.]+$', '') AS stem,
          CAST(len(string_split(split_part(url, '?', 1), '/')) - 1 AS INTEGER) AS depth FROM pages""",
)
def path_parts(t: Tables) -> DataFrame:
    path = F.split_part("url", F.lit("?"), F.lit(1))
    return t.pages.select(
        "page_id", text.path_ext(path).alias("ext"), text.path_stem(path).alias("stem"), text.path_depth(path).alias("depth")
    )


@query(
    "log_parse",
    """SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, 'user ' || user_id AS message FROM events WHERE event_type = 'error'""",
)
def log_parse(t: Tables) -> DataFrame:
    return words.errors(views.log_lines(t), "value")


@query(
    "line_numbers",
    """WITH l AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS number, event_type FROM events)
       SELECT CAST(sum(number) AS BIGINT) AS total, count(*) AS lines FROM
         (SELECT number FROM l WHERE event_type = 'click' ORDER BY number LIMIT 100)""",
)
def line_numbers(t: Tables) -> DataFrame:
    lines = words.numbered_lines(t.events.select("event_id", "event_type"), "event_type", "event_id")
    return words.sum_first_numbers(lines.where(c("value").endswith("click")), "value", 100)


@query(
    "html_stats",
    f"""SELECT page_id, CAST(length(html) AS INTEGER) AS chars, CAST(len(string_split(html, chr(10))) AS INTEGER) AS lines,
          CAST(len({_words('html')}) AS INTEGER) AS words, CAST(len(list_distinct({_words('html')})) AS INTEGER) AS distinct_words,
          array_to_string(({_words('html')})[1:20], ' ') AS first_words FROM pages""",
)
def html_stats(t: Tables) -> DataFrame:
    return words.html_stats(t.pages, "page_id", "html")


@query(
    "div_count",
    r"""SELECT CAST(sum(len(regexp_extract_all(html, '(?i)<div\b[^>]*>'))) AS BIGINT) AS tags,
          CAST(sum(len(regexp_extract_all(html, '<div/?>'))) AS BIGINT) AS literal FROM pages""",
)
def div_count(t: Tables) -> DataFrame:
    x = c("html")
    return t.pages.agg(
        F.sum(text.tag_count(x, "div")).alias("tags"), F.sum(text.tag_count(x, "div", literal=True)).alias("literal")
    )


@query(
    "link_count",
    r"""SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<a\b[^>]*>')) AS INTEGER) AS links FROM pages""",
)
def link_count(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.link_count(c("html")).alias("links"))


@query(
    "most_links",
    r"""SELECT page_id AS id, CAST(len(regexp_extract_all(html, '(?i)<a\b[^>]*>')) AS INTEGER) AS links FROM pages
        ORDER BY links DESC, page_id LIMIT 1""",
)
def most_links(t: Tables) -> DataFrame:
    return words.most_links(t.pages, "page_id", "html")


_HITS = "len(list_filter(string_split(url, '/'), lambda x: contains(x, 'example.org')))"


@query("domain_tokens", f"SELECT page_id, CAST({_HITS} AS INTEGER) AS hits FROM pages")
def domain_tokens(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.token_hits(c("url"), "example.org", "/").alias("hits"))


@query("domain_total", f"SELECT CAST(sum({_HITS}) AS BIGINT) AS hits FROM pages")
def domain_total(t: Tables) -> DataFrame:
    return t.pages.agg(F.sum(text.token_hits(c("url"), "example.org", "/")).alias("hits"))


@query("uri_tail", "SELECT page_id, string_split(url, '/')[-1] AS tail FROM pages")
def uri_tail(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.uri_tail(c("url")).alias("tail"))


@query(
    "url_basename",
    "SELECT page_id, left(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], 100) AS name FROM pages",
)
def url_basename(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.url_basename(c("url")).alias("name"))


@query(
    "ts_day",
    """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(year(ts) AS INTEGER) AS year FROM events""",
)
def ts_day(t: Tables) -> DataFrame:
    day = text.to_day(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.events.select("event_id", day.cast("timestamp_ntz").alias("day"), F.year("ts").alias("year"))


@query(
    "wkt_point",
    "SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS lat, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon FROM customer",
)
def wkt_point(t: Tables) -> DataFrame:
    x = c("coordinates")
    return views.wkt(t).select("c_custkey", text.wkt_lat(x).alias("lat"), text.wkt_lon(x).alias("lon"))


@query(
    "complex_abs",
    "SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity * l_quantity + l_tax * l_tax), 8) AS modulus FROM lineitem",
)
def complex_abs(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(numbers.modulus(c("l_quantity"), c("l_tax")), 8).alias("modulus")
    )


@query(
    "hex_colour",
    f"""WITH {views.PIXELS}, m AS (SELECT image_id, x, CAST(ceil(round(avg(r), 6)) AS INTEGER) AS r, CAST(ceil(round(avg(g), 6)) AS INTEGER) AS g,
          CAST(ceil(round(avg(b), 6)) AS INTEGER) AS b FROM pixels GROUP BY 1, 2)
        SELECT image_id, x, lower(format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b)) AS colour FROM m""",
)
def hex_colour(t: Tables) -> DataFrame:
    means = views.pixels(t).groupBy("image_id", "x").agg(*[F.round(F.avg(b), 6).alias(b) for b in "rgb"])
    return means.select("image_id", "x", colour.hex_colour(c("r"), c("g"), c("b")).alias("colour"))


@query(
    "rgb_to_hsv",
    f"""WITH {views.PIXELS}, m AS (SELECT DISTINCT r, g, b, greatest(r, g, b) AS top, greatest(r, g, b) - least(r, g, b) AS span FROM pixels)
        SELECT r, g, b, round(CASE WHEN span = 0 THEN 0 WHEN top = r AND g >= b THEN 60.0 * (g - b) / span
            WHEN top = r THEN 60.0 * (g - b) / span + 360 WHEN top = g THEN 60.0 * (b - r) / span + 120
            ELSE 60.0 * (r - g) / span + 240 END, 6) AS h,
          round(CASE WHEN top = 0 THEN 0.0 ELSE span / top END, 6) AS s, round(top / 255.0, 6) AS v FROM m""",
)
def rgb_to_hsv(t: Tables) -> DataFrame:
    hsv = colour.rgb_to_hsv(c("r"), c("g"), c("b"))
    rows = views.pixels(t).select("r", "g", "b").distinct().withColumn("hsv", hsv)
    return rows.select("r", "g", "b", *[F.round(f"hsv.{x}", 6).alias(x) for x in "hsv"])


_PART_LIST = "[p_name, p_brand, p_type]"


@query(
    "array_ops",
    f"""SELECT p_partkey, p_name || ',' || p_brand || ',' || p_type || ',end' AS appended, p_name || ',new,' || p_type AS replaced,
          p_name || ',new,' || p_brand || ',' || p_type AS inserted, p_name || ',' || p_brand || ',' || p_type || ',new' AS past_end,
          p_brand || ',' || p_type AS sliced, list_contains({_PART_LIST}, 'ECONOMY') AS member FROM part""",
)
def array_ops(t: Tables) -> DataFrame:
    x = F.array("p_name", "p_brand", "p_type")

    def shown(col, name: str):
        return F.array_join(col, ",").alias(name)

    return t.part.select(
        "p_partkey",
        shown(F.array_append(x, F.lit("end")), "appended"),
        shown(arrays.array_set(x, 1, "new"), "replaced"),
        shown(arrays.array_put(x, 1, "new"), "inserted"),
        shown(arrays.array_put(x, 9, "new"), "past_end"),
        shown(arrays.array_cut(x, 1, 3), "sliced"),
        F.array_contains(x, "ECONOMY").alias("member"),
    )


@query(
    "array_comprehension",
    """SELECT vec_id, CAST(len(list_filter(embedding, lambda v: v > 0)) AS INTEGER) AS positive,
         round(list_sum(list_transform(list_filter(embedding, lambda v: v > 0), lambda v: CAST(v AS DOUBLE) * v)), 6) AS squares
       FROM embeddings""",
)
def array_comprehension(t: Tables) -> DataFrame:
    squares = arrays.comprehend(c("embedding"), lambda v: v.cast("double") * v, lambda v: v > 0)
    total = F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v)
    return t.embeddings.select("vec_id", F.size(squares).alias("positive"), F.round(total, 6).alias("squares"))


@query(
    "array_set_ops",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN p_brand || ',' || p_type ELSE p_brand || ',' || p_type || ',Brand#1' END AS added,
         CASE WHEN p_type = 'ECONOMY' THEN p_brand ELSE p_brand || ',' || p_type END AS removed FROM part""",
)
def array_set_ops(t: Tables) -> DataFrame:
    x = F.array_distinct(F.array("p_brand", "p_type", "p_brand"))
    return t.part.select(
        "p_partkey",
        F.array_join(arrays.set_add(x, "Brand#1"), ",").alias("added"),
        F.array_join(arrays.set_remove(x, "ECONOMY"), ",").alias("removed"),
    )


@query("udf_century", "SELECT o_orderkey, CAST(floor(year(o_orderdate) / 100) AS BIGINT) + 1 AS century FROM orders")
def udf_century(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", udfs.udf_century(F.year("o_orderdate")).alias("century"))


@query("map_in_pandas_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def map_in_pandas_filter(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return udfs.batch_filter(rows, lambda pdf: pdf["o_totalprice"] > 250000)


@query("apply_cell", "SELECT c_custkey, CAST(length(c_name) * 2 AS BIGINT) AS twice FROM customer")
def apply_cell(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name")
    return udfs.apply_cell(rows, "c_name", lambda s: 2 * len(s), "long", "twice").drop("c_name")


@query("sql_view", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY o_orderstatus")
def sql_view(t: Tables) -> DataFrame:
    statement = "SELECT o_orderstatus, count(*) AS n FROM bought WHERE year(o_orderdate) = 1997 GROUP BY o_orderstatus"
    return udfs.sql_view(t.orders, "bought", statement)


@query("scatter_sample")
def scatter_sample(t: Tables) -> DataFrame:
    return feeds.scatter_feed(t.part, "p_partkey", "p_size", "p_retailprice", "p_type", 500, seed=1)


@query(
    "marker_feed",
    f"""WITH {views.WKT} SELECT c_custkey AS id, c_name AS label, CAST(regexp_extract(coordinates, ' (-?[0-9]+)', 1) AS DOUBLE) AS lat,
          CAST(regexp_extract(coordinates, '[(](-?[0-9]+)', 1) AS DOUBLE) AS lon,
          '<a href=''#' || c_custkey || '''>' || c_name || '</a>' AS popup FROM wkt""",
)
def marker_feed(t: Tables) -> DataFrame:
    return feeds.marker_feed(views.wkt(t), "c_custkey", "c_name", "coordinates")
