"""Queries on classifiers, clusters and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import classify, cluster, features, metrics, recommend
from tallyloom.operators.dbscan import dbscan
from tallyloom.operators.ward import ward
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query
from tallyloom.session import cut_lineage

c = F.col
_RGB = ["r", "g", "b"]


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({x: F.round(x, digits) for x in cols})


def _report(t: Tables, make) -> DataFrame:
    """Stratified split, fit on one part, report on the other."""
    train, test = features.split_stratified(t.embeddings, "vec_id", "label", 0.7, seed=1)
    return metrics.classification_report(make(train).predict(test), "label", "prediction")


@query("perceptron")
def perceptron(t: Tables) -> DataFrame:
    return _report(t, lambda train: classify.fit_perceptron(train, "embedding", "label", epochs=5, eta0=0.1))


@query("svm_linear")
def svm_linear(t: Tables) -> DataFrame:
    return _report(t, lambda train: classify.fit_svm(train, "embedding", "label", max_iter=10))


@query("svm_rbf")
def svm_rbf(t: Tables) -> DataFrame:
    return _report(t, lambda train: classify.fit_svm(train, "embedding", "label", kernel="rbf", gamma=0.5, max_iter=10))


@query("svm_poly")
def svm_poly(t: Tables) -> DataFrame:
    """The items, told apart by size and price, with a cubic kernel."""
    rows = t.part.select("p_partkey", (c("p_size") / 50).alias("size"), ((c("p_retailprice") - 900) / 1000).alias("price"),
                         (c("p_retailprice") > 900 + 10 * c("p_size")).cast("int").alias("dear"))
    train, test = features.split_random(rows, "p_partkey", 0.3, seed=1)
    fit = classify.fit_svm(train, ["size", "price"], "dear", kernel="poly", max_iter=20)
    return metrics.classification_report(fit.predict(test), "dear", "prediction")


@query("mlp")
def mlp(t: Tables) -> DataFrame:
    return _report(t, lambda train: classify.fit_mlp(train, "embedding", "label", hidden=(32,), max_iter=40))


@query("decision_tree")
def decision_tree(t: Tables) -> DataFrame:
    return _report(t, lambda train: classify.fit_tree(train, "embedding", "label", max_depth=6))


@query("tree_nodes")
def tree_nodes(t: Tables) -> DataFrame:
    return classify.tree_nodes(classify.fit_tree(t.embeddings, "embedding", "label", max_depth=4), t.spark)


@query("random_forest")
def random_forest(t: Tables) -> DataFrame:
    return _report(t, lambda train: classify.fit_forest(train, "embedding", "label", trees=10, max_depth=5))


@query("forest_importances")
def forest_importances(t: Tables) -> DataFrame:
    fit = classify.fit_forest(t.embeddings, "embedding", "label", trees=10, max_depth=2)
    return classify.importances(fit, t.embeddings)


@query("cross_validation")
def cross_validation(t: Tables) -> DataFrame:
    scores = classify.cross_validate(
        lambda train: classify.fit_tree(train, "embedding", "label", max_depth=4), t.embeddings, "vec_id", "label", 3
    )
    return classify.cv_summary(scores)


@query("grid_table")
def grid_table(t: Tables) -> DataFrame:
    train, test = features.split_stratified(t.embeddings, "vec_id", "label", 0.7, seed=1)
    depths = [{"max_depth": d} for d in (1, 2, 4)]
    return classify.grid_table(lambda df, **p: classify.fit_tree(df, "embedding", "label", **p), depths, train, test, "label")


_NEAREST = f"""d AS (SELECT *, {", ".join(
    f"(r - {r}) * (r - {r}) + (g - {g}) * (g - {g}) + (b - {b}) * (b - {b}) AS d{i}" for i, (r, g, b) in enumerate(views.CENTRES)
)} FROM pixels), m AS (SELECT *, least(d0, d1, d2, d3) AS d, CAST(CASE least(d0, d1, d2, d3) WHEN d0 THEN 0 WHEN d1 THEN 1
  WHEN d2 THEN 2 ELSE 3 END AS INTEGER) AS cluster FROM d)"""
_PLACED = f"WITH {views.PIXELS}, {_NEAREST}"


@query("nearest_centre", f"{_PLACED} SELECT image_id, x, y, r, g, b, cluster AS prediction FROM m")
def nearest_centre(t: Tables) -> DataFrame:
    return classify.nearest_centre(views.pixels(t), _RGB, views.CENTRES)


@query("lloyd_step", f"{_PLACED} SELECT cluster, round(avg(r), 6) AS r, round(avg(g), 6) AS g, round(avg(b), 6) AS b, count(*) AS n FROM m GROUP BY 1")
def lloyd_step(t: Tables) -> DataFrame:
    return _round(cluster.lloyd_step(views.pixels(t), _RGB, views.CENTRES), 6, *_RGB)


@query("cluster_sizes", f"{_PLACED} SELECT cluster, count(*) AS n, round(count(*) / (SELECT count(*) FROM m), 6) AS share FROM m GROUP BY 1")
def cluster_sizes(t: Tables) -> DataFrame:
    placed = classify.nearest_centre(views.pixels(t), _RGB, views.CENTRES, "label")
    return _round(cluster.cluster_sizes(placed, "label"), 6, "share")


@query("inertia", f"{_PLACED} SELECT CAST(sum(d) AS DOUBLE) AS inertia FROM m")
def inertia(t: Tables) -> DataFrame:
    return cluster.inertia(views.pixels(t), _RGB, views.CENTRES)


@query(
    "compare_centres",
    f"""{_PLACED}, {views.CENTRES_SQL}, n AS (SELECT cluster, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM m GROUP BY 1),
        j AS (SELECT n.cluster, k.cluster AS nearest, sqrt((r - cr) * (r - cr) + (g - cg) * (g - cg) + (b - cb) * (b - cb)) AS distance
          FROM n, centres k)
        SELECT cluster, arg_min(nearest, distance) AS nearest, round(min(distance), 6) AS distance FROM j GROUP BY cluster""",
)
def compare_centres(t: Tables) -> DataFrame:
    moved = cluster.lloyd_step(views.pixels(t), _RGB, views.CENTRES)
    fixed = cluster.CentreFit(tuple(_RGB), tuple(views.CENTRES), 0.0)
    start = fixed.table(moved)
    return _round(cluster.compare_centres(moved.select("cluster", *_RGB), start, _RGB), 6, "distance")


@query("kmeans")
def kmeans(t: Tables) -> DataFrame:
    px = views.pixels(t)
    fit = cluster.fit_kmeans(px, _RGB, 4, n_init=2, seed=1)
    sizes = cluster.cluster_sizes(fit.assign(px, "label"), "label")
    return fit.table(px).join(sizes, "cluster")


@query("kmeans_quality")
def kmeans_quality(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", (c("p_size") / 10).alias("size"), ((c("p_retailprice") - 900) / 100).alias("price"))
    return cluster.quality_table(rows, "p_partkey", ["size", "price"], [2, 3, 4], seed=1).drop("seconds")


@query("elbow")
def elbow(t: Tables) -> DataFrame:
    return cluster.elbow(views.pixels(t), _RGB, list(range(2, 11)), seed=1, max_iter=10)


@query("kmeans_grouped")
def kmeans_grouped(t: Tables) -> DataFrame:
    return cluster.fit_kmeans_grouped(views.pixels(t), "image_id", _RGB, [2, 3, 4], n_init=2, seed=1, max_iter=6)


@query("minibatch_kmeans")
def minibatch_kmeans(t: Tables) -> DataFrame:
    px = views.pixels(t)
    fit = cluster.fit_minibatch_kmeans(px, _RGB, 4, batch=512, steps=8, seed=1)
    return fit.table(px).withColumn("inertia", F.lit(fit.inertia))


@query("palette")
def palette(t: Tables) -> DataFrame:
    return cluster.extract_palette(views.pixels(t), 5, seed=1)


@query("kmeans_after_filter")
def kmeans_after_filter(t: Tables) -> DataFrame:
    """Clusters of year and price among the orders after a year."""
    rows = t.orders.select(F.year("o_orderdate").alias("year"), (c("o_totalprice") / 100000).alias("price")).where("year > 1995")
    return cluster.fit_kmeans(rows, ["year", "price"], 3, n_init=2, seed=1).table(rows)


@query(
    "silhouette_exact",
    """WITH p AS (SELECT x.vec_id AS i, x.label AS li, y.label AS lj, y.vec_id AS j,
         sqrt(list_sum(list_transform(list_zip(x.embedding, y.embedding), lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2]))))
           AS d FROM embeddings x, embeddings y WHERE x.vec_id <> y.vec_id),
       m AS (SELECT i, li, lj, avg(d) AS d FROM p GROUP BY 1, 2, 3),
       s AS (SELECT i, max(CASE WHEN li = lj THEN d END) AS a, min(CASE WHEN li <> lj THEN d END) AS b FROM m GROUP BY 1)
       SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""",
)
def silhouette_exact(t: Tables) -> DataFrame:
    return _round(cluster.silhouette(t.embeddings, "vec_id", "embedding", "label"), 6, "silhouette")


@query(
    "silhouette_squared",
    """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
       u AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
       s AS (SELECT label, i, sum(x) AS y FROM u GROUP BY 1, 2),
       k AS (SELECT label, list(y ORDER BY i) AS y FROM s GROUP BY 1),
       n AS (SELECT label, count(*) AS n, sum(list_dot_product(v, v)) AS psi FROM e GROUP BY 1),
       d AS (SELECT vec_id, e.label AS own, k.label AS other, n, list_dot_product(v, v) + psi / n - 2 * list_dot_product(v, y) / n AS d
         FROM e, k JOIN n USING (label)),
       m AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d END) AS b
         FROM d GROUP BY 1)
       SELECT round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM m""",
)
def silhouette_squared(t: Tables) -> DataFrame:
    return _round(cluster.silhouette_squared(t.embeddings, "embedding", "label"), 6, "silhouette")


@query("silhouette_sample")
def silhouette_sample(t: Tables) -> DataFrame:
    """The silhouette of at most 2000 rows, with the number of rows used."""
    return cluster.silhouette_sample(t.embeddings, "vec_id", "embedding", "label", 2000, seed=1)


@query(
    "dbscan",
    """WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal / 100 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer),
       near AS (SELECT a.id AS u, b.id AS v FROM p a, p b WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 1.0),
       core AS (SELECT u AS id FROM near GROUP BY u HAVING count(*) >= 4),
       edge AS (SELECT u, v FROM near WHERE u IN (SELECT id FROM core) AND v IN (SELECT id FROM core)),
       reach AS (SELECT id, id AS r FROM core UNION SELECT reach.id, v FROM reach JOIN edge ON u = r),
       comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id),
       num AS (SELECT id, dense_rank() OVER (ORDER BY c) - 1 AS k FROM comp),
       border AS (SELECT u AS id, min(k) AS k FROM near JOIN num ON num.id = v WHERE u NOT IN (SELECT id FROM core) GROUP BY u)
       SELECT p.id, coalesce(num.k, border.k, -1) AS cluster, num.id IS NOT NULL AS core
       FROM p LEFT JOIN num ON num.id = p.id LEFT JOIN border ON border.id = p.id""",
)
def dbscan_customers(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", (c("c_acctbal") / 100).alias("balance"), c("c_nationkey").cast("double").alias("nation"))
    return dbscan(rows, "c_custkey", ["balance", "nation"], eps=1.0, min_samples=4)


@query("ward")
def ward_parts(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_size", F.substring("p_brand", 7, 9).cast("int").alias("brand"))
    return ward(rows, "p_partkey", ["p_size", "brand"], 5)


@query("recommend_cluster")
def recommend_cluster(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", (c("p_size") / 10).alias("size"), ((c("p_retailprice") - 900) / 100).alias("price"))
    fit = cluster.fit_kmeans(rows, ["size", "price"], 6, seed=1)
    return recommend.recommend_peers(fit.assign(rows), "p_partkey", "cluster", 3, seed=1)


@query("recommend_class")
def recommend_class(t: Tables) -> DataFrame:
    bought = t.lineitem.groupBy(c("l_partkey").alias("item")).agg(F.sum("l_quantity").alias("q"))
    rows = views.items(t).join(bought, "item").withColumn("favourite", (c("q") > 750).cast("int"))
    # Learnt from four fifths of the items, judged on the others.
    train, test = features.split_random(cut_lineage(rows), "item", 0.2, seed=1)
    fit, _, codes = recommend.fit_favourite(train, _ATTRS, "favourite", model="tree")
    return metrics.classification_report(recommend.predict_favourite(fit, codes, test), "favourite", "prediction")


@query("recommend_new_item")
def recommend_new_item(t: Tables) -> DataFrame:
    """How every part would be judged in a type that no part has: ``item, prediction``."""
    bought = t.lineitem.groupBy(c("l_partkey").alias("item")).agg(F.sum("l_quantity").alias("q"))
    rows = views.items(t).join(bought, "item").withColumn("favourite", (c("q") > 750).cast("int"))
    fit, _, codes = recommend.fit_favourite(rows, _ATTRS, "favourite", model="tree")
    new = views.items(t).withColumn("p_type", F.lit("NEW KIND"))
    return recommend.predict_favourite(fit, codes, new).select("item", "prediction")


_ATTRS = ["p_brand", "p_type", "p_size"]
_PREFS = f"""{views.LIKES}, {views.ITEMS}, li AS (SELECT item, 'p_brand' AS attr, p_brand AS value FROM items UNION ALL
  SELECT item, 'p_type', p_type FROM items UNION ALL SELECT item, 'p_size', p_size FROM items),
  prefs AS (SELECT "user", attr, value, count(*) AS n FROM likes JOIN li USING (item) GROUP BY 1, 2, 3)"""


@query(
    "user_profile",
    f"""WITH {_PREFS}, r AS (SELECT *, row_number() OVER (PARTITION BY "user", attr ORDER BY n DESC, value) AS rn FROM prefs)
        SELECT "user", attr, value, n FROM r WHERE rn = 1""",
)
def user_profile(t: Tables) -> DataFrame:
    return recommend.user_profile(views.likes(t), views.items(t), _ATTRS)


@query(
    "content_scores",
    f"""WITH {_PREFS}, s AS (SELECT "user", item, CAST(sum(n) AS BIGINT) AS score FROM prefs JOIN li USING (attr, value) GROUP BY 1, 2),
        f AS (SELECT * FROM s ANTI JOIN likes USING ("user", item)),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS INTEGER) AS rank FROM f)
        SELECT * FROM r WHERE rank <= 5""",
)
def content_scores(t: Tables) -> DataFrame:
    return recommend.content_scores(views.likes(t), views.items(t), _ATTRS, 5)


@query("als_topn")
def als_topn(t: Tables) -> DataFrame:
    return recommend.als_top_n(recommend.fit_als(views.likes(t), seed=1), views.likes(t), 5)


@query("hybrid_topn")
def hybrid_topn(t: Tables) -> DataFrame:
    content = cut_lineage(recommend.content_scores(views.likes(t), views.items(t), _ATTRS, 10))
    taste = cut_lineage(recommend.als_top_n(recommend.fit_als(views.likes(t), seed=1), views.likes(t), 10))
    return recommend.hybrid(content, taste, 0.5, 5)


@query(
    "catalogue_counts",
    f"""WITH {_PREFS} SELECT attr, value, count(*) AS n, 'all' AS who FROM li GROUP BY 1, 2 UNION ALL
        SELECT attr, value, count(*), 'user 1' FROM li SEMI JOIN (SELECT item FROM likes WHERE "user" = 1) USING (item) GROUP BY 1, 2""",
)
def catalogue_counts(t: Tables) -> DataFrame:
    everyone = recommend.catalogue_counts(views.items(t), _ATTRS).withColumn("who", F.lit("all"))
    one = recommend.catalogue_counts(views.items(t), _ATTRS, views.likes(t), 1)
    return everyone.union(one.withColumn("who", F.lit("user 1")))


@query(
    "tag_freq",
    """WITH w AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ') || [lower(p_type)]) AS tag FROM part)
       SELECT tag, count(*) AS n FROM w GROUP BY tag""",
)
def tag_freq(t: Tables) -> DataFrame:
    loud = F.transform(F.split("p_name", " "), lambda w: F.concat(F.lit("#"), F.upper(w)))
    rows = t.part.select(F.concat(loud, F.split("p_name", " "), F.array("p_type", F.lit("# "))).alias("tags"))
    return recommend.tag_freq(rows, "tags")
