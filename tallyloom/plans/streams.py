"""Queries on streams: each reads a table as a file stream, runs it to its end and returns the stored result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.features import split_stratified
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query
from tallyloom.session import scratch_path
from tallyloom.sources.files import write_lines
from tallyloom.streaming import consume, online, running, sources

c = F.col


def _stream(t: Tables, name: str) -> DataFrame:
    # The braces make the path a pattern, which a stream accepts for a single file as well as for a folder.
    path = f"{t.folder}/{name}.{{parquet}}"
    return sources.stream_table(t.spark, path, t.spark.read.parquet(path).schema)


def _places(t: Tables, *names: str) -> list[str]:
    base = scratch_path(t.spark, "stream")
    return [f"{base}/{n}" for n in names]


def _finish(done: bool) -> None:
    if not done:
        raise TimeoutError("the stream did not end in time")


def _running(t: Tables, counts: DataFrame, schema: str, keys: list[str]) -> DataFrame:
    out, mark = _places(t, "out", "checkpoint")
    _finish(consume.run_updates(counts, out, mark, schema, keys))
    return consume.latest(t.spark, out, schema, keys)


def _log_files(t: Tables, path: str) -> None:
    write_lines(views.log_lines(t).repartition(4), path)


@query("stream_folder_count", "SELECT CAST(4 AS BIGINT) AS files, count(*) AS lines FROM events")
def stream_folder_count(t: Tables) -> DataFrame:
    source, out, mark, archive = _places(t, "in", "out", "checkpoint", "archive")
    _log_files(t, source)

    def count(lines: DataFrame, batch_id: int) -> None:
        consume.write_batch(lines.groupBy("file").agg(F.count("*").alias("n")), out, batch_id)

    _finish(sources.watch_folder(t.spark, source, count, mark, archive, max_files=2))
    rows = consume.read_batches(t.spark, out, "file string, n long")
    return rows.agg(F.count_distinct("file").alias("files"), F.sum("n").alias("lines"))


@query("stream_consume", "SELECT event_id, upper(event_type) AS task FROM events")
def stream_consume(t: Tables) -> DataFrame:
    out, mark = _places(t, "out", "checkpoint")
    _finish(consume.consume(
        _stream(t, "events"), lambda df: df.select("event_id", F.upper("event_type").alias("task")), out, mark
    ))
    return consume.read_batches(t.spark, out, "event_id long, task string").drop("batch")


@query(
    "stream_dead_letter",
    """SELECT 'good' AS kind, count(*) AS n FROM events WHERE event_type <> 'error' UNION ALL
       SELECT 'bad', count(*) FROM events WHERE event_type = 'error'""",
)
def stream_dead_letter(t: Tables) -> DataFrame:
    out, bad, mark = _places(t, "out", "bad", "checkpoint")
    body = F.when(c("event_type") == "error", "no json").otherwise(c("props"))
    messages = _stream(t, "events").select("event_id", body.alias("body"))
    number = F.from_json("body", "k long")["k"]
    _finish(consume.consume(
        messages, lambda df: df.select("event_id", number.alias("k")), out, mark, good=number.isNotNull(), dead_letter=bad
    ))
    good = consume.read_batches(t.spark, out, "event_id long, k long").agg(F.count("*").alias("n"))
    left = consume.read_batches(t.spark, bad, "event_id long, body string").agg(F.count("*").alias("n"))
    return good.select(F.lit("good").alias("kind"), "n").union(left.select(F.lit("bad"), "n"))


@query(
    "stream_failing_work",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 1000 // (event_id % 10) END AS result,
         CASE WHEN event_id % 10 = 0 THEN 'ZeroDivisionError' END AS error FROM events""",
)
def stream_failing_work(t: Tables) -> DataFrame:
    """Messages whose work raises are set aside, the others have a result; the events arrive in four files."""
    source, out, mark = _places(t, "in", "out", "checkpoint")
    t.events.select("event_id").repartition(4, "event_id").write.parquet(source)
    stream = sources.stream_table(t.spark, source, t.spark.read.parquet(source).schema, max_files=1)
    _finish(consume.consume_each(stream, lambda m: 1000 // (m["event_id"] % 10), "long", out, mark))
    fine = consume.worked(t.spark, out, "event_id long", "long", False).withColumn("error", F.lit(None).cast("string"))
    bad = consume.worked(t.spark, out, "event_id long", "long", True).withColumn("result", F.lit(None).cast("long"))
    return fine.unionByName(bad).select("event_id", "result", F.substring_index("error", ":", 1).alias("error"))


@query(
    "stream_prime_summary",
    """WITH p AS (SELECT event_id AS v, event_id > 1 AND NOT EXISTS (SELECT 1 FROM range(2, 2000) d(d) WHERE d.d * d.d <= event_id
         AND event_id % d.d = 0) AS is_prime FROM events)
       SELECT is_prime, count(*) AS n, max(v) AS largest FROM p GROUP BY is_prime""",
)
def stream_prime_summary(t: Tables) -> DataFrame:
    return _running(t, running.prime_stream(_stream(t, "events"), "event_id"), "is_prime boolean, n long, largest long", ["is_prime"])


@query(
    "stream_error_logs",
    """SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, 'user ' || user_id AS message FROM events WHERE event_type = 'error'""",
)
def stream_error_logs(t: Tables) -> DataFrame:
    source, out, mark = _places(t, "in", "out", "checkpoint")
    _log_files(t, source)
    errors = running.error_stream(sources.stream_lines(t.spark, source, max_files=2))
    _finish(sources.run_available(errors.writeStream.format("parquet").option("path", out), mark))
    return t.spark.read.schema("ts timestamp_ntz, message string").parquet(out)


@query(
    "stream_word_count",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(text),
         '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> '')) AS word
         FROM conversations) GROUP BY word""",
)
def stream_word_count(t: Tables) -> DataFrame:
    return _running(t, running.running_word_count(_stream(t, "conversations"), "text"), "word string, n long", ["word"])


@query("stream_value_count", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def stream_value_count(t: Tables) -> DataFrame:
    return _running(t, running.running_value_count(_stream(t, "events"), "event_type"), "value string, n long", ["value"])


@query("stream_perceptron")
def stream_perceptron(t: Tables) -> DataFrame:
    """Accuracy of a perceptron that saw the vectors as a stream."""
    state, mark = _places(t, "weights", "checkpoint")
    learner = online.OnlinePerceptron(t.spark, range(10), "embedding", "label", 64, state, eta0=0.1)
    stream = _stream(t, "embeddings")
    _finish(sources.run_available(stream.writeStream.foreachBatch(learner.update), mark))
    guessed = learner.classifier().predict(t.embeddings)
    return guessed.agg(
        F.count("*").alias("rows"), F.avg((c("label") == c("prediction")).cast("double")).alias("accuracy")
    )


@query("online_study")
def online_study(t: Tables) -> DataFrame:
    """Accuracy of an online perceptron given a quarter, a half and three quarters of the training rows."""
    train, test = split_stratified(t.embeddings, "vec_id", "label", 0.7, seed=1)
    return online.online_study(train, test, "vec_id", "embedding", "label", range(10), 64, scratch_path(t.spark, "study"))


@query("online_mlp_study")
def online_mlp_study(t: Tables) -> DataFrame:
    """A multi-layer perceptron taught online and in batch, by share of the training rows."""
    train, test = split_stratified(t.embeddings, "vec_id", "label", 0.7, seed=1)
    return online.online_mlp_study(train, test, "vec_id", "embedding", "label", range(10), 64)


@query("hidden_layer_table")
def hidden_layer_table(t: Tables) -> DataFrame:
    """Accuracy and seconds of multi-layer perceptrons taught online, by their hidden layers."""
    train, test = split_stratified(t.embeddings, "vec_id", "label", 0.7, seed=1)
    sizes = ((25,), (50,), (100,), (50, 50))
    rows = online.online_mlp_study(train, test, "vec_id", "embedding", "label", range(10), 64, sizes, (1.0,))
    return rows.select("hidden", "online_accuracy", "batch_accuracy", "online_seconds", "batch_seconds")


@query("stream_mlp")
def stream_mlp(t: Tables) -> DataFrame:
    """Accuracy of a multi-layer perceptron that saw the vectors as a stream."""
    state, mark = _places(t, "weights", "checkpoint")
    learner = online.OnlineMlp(t.spark, range(10), "embedding", "label", 64, state, steps=20, rate=0.02)
    _finish(sources.run_available(_stream(t, "embeddings").writeStream.foreachBatch(learner.update), mark))
    guessed = learner.classifier().predict(t.embeddings)
    return guessed.agg(
        F.count("*").alias("rows"), F.avg((c("label") == c("prediction")).cast("double")).alias("accuracy")
    )


@query("stream_kmeans")
def stream_kmeans(t: Tables) -> DataFrame:
    state, mark = _places(t, "centres", "checkpoint")
    learner = online.OnlineKMeans(t.spark, ["r", "g", "b"], 4, state, seed=1)

    class Streamed(Tables):
        def __getattr__(self, name: str) -> DataFrame:
            return _stream(t, name)

    stream = views.pixels(Streamed(t.spark, t.folder))
    _finish(sources.run_available(stream.writeStream.foreachBatch(learner.update), mark))
    counts = t.spark.createDataFrame([(i, int(n)) for i, n in enumerate(learner.counts())], "cluster int, n long")
    return learner.fit().table(t.orders).join(counts, "cluster")
