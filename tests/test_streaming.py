import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators.metrics import accuracy
from tallyloom.streaming import consume, online, running, sources


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def put(spark, where, name, lines):
    (where / name).write_text("\n".join(lines) + "\n")


def test_each_file_is_processed_once_and_archived(spark, tmp_path, place):
    inbox = tmp_path / "in"
    inbox.mkdir()
    put(spark, inbox, "a.txt", ["one", "two"])

    def work(lines, batch_id):
        consume.write_batch(lines.groupBy("file").agg(F.count("*").alias("n")), place("out"), batch_id)

    def total():
        return consume.read_batches(spark, place("out"), "file string, n long").agg(F.sum("n")).first()[0]

    assert sources.watch_folder(spark, str(inbox), work, place("mark"), place("archive"), timeout=120)
    assert total() == 2
    put(spark, inbox, "b.txt", ["three"])
    assert sources.watch_folder(spark, str(inbox), work, place("mark"), place("archive"), timeout=120)
    assert total() == 3
    assert sources.watch_folder(spark, str(inbox), work, place("mark"), place("archive"), timeout=120)
    assert total() == 3


def test_bad_messages_are_set_aside(spark, tmp_path, place):
    inbox = tmp_path / "in"
    inbox.mkdir()
    put(spark, inbox, "a.txt", ["1", "x", "3"])
    put(spark, inbox, "b.txt", ["", "5"])
    stream = sources.stream_lines(spark, str(inbox), max_files=1)
    number = F.col("value").try_cast("long")
    args = (lambda df: df.select(number.alias("n")), place("out"), place("mark"))
    for _ in range(2):
        assert consume.consume(stream, *args, good=number.isNotNull(), dead_letter=place("bad"), timeout=120)
    good = consume.read_batches(spark, place("out"), "n long")
    assert sorted(r["n"] for r in good.collect()) == [1, 3, 5]
    assert good.select("batch").distinct().count() == 2
    assert consume.read_batches(spark, place("bad"), "value string").count() == 2


def test_running_counts_keep_their_state_over_restarts(spark, tmp_path, place):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for name, lines in (("a.txt", ["The cat", "the dog"]), ("b.txt", ["THE end"])):
        put(spark, inbox, name, lines)
        counts = running.running_word_count(sources.stream_lines(spark, str(inbox)))
        assert consume.run_updates(counts, place("out"), place("mark"), "word string, n long", ["word"], 120)
    got = {r["word"]: r["n"] for r in consume.latest(spark, place("out"), "word string, n long", ["word"]).collect()}
    assert got == {"the": 3, "cat": 1, "dog": 1, "end": 1}


def test_state_is_folded_and_old_batches_are_not_read(spark, tmp_path, place):
    """Ten batches of one file each, a restart in the middle, snapshots every third batch."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    schema, keys = "word string, n long", ["word"]
    for start in (0, 5):
        for i in range(start, start + 5):
            put(spark, inbox, f"{i}.txt", ["often", f"word{i % 4}", f"only{i}"])
        counts = running.running_word_count(sources.stream_lines(spark, str(inbox), max_files=1))
        assert consume.run_updates(counts, place("out"), place("mark"), schema, keys, 240, every=3)
    want = {"often": 10, **{f"word{i}": 3 if i < 2 else 2 for i in range(4)}, **{f"only{i}": 1 for i in range(10)}}
    got = lambda: {r["word"]: r["n"] for r in consume.latest(spark, place("out"), schema, keys, every=3).collect()}
    assert got() == want
    # The first batches could be gone: what they held is in the last snapshot.
    for batch in range(9):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{place('out')}/batch={batch}")
    assert got() == want


def test_work_that_raises_sets_its_message_aside(spark, tmp_path, place):
    def work(message):
        value = message["value"]
        if value == "boom":
            raise ValueError("no use")
        return {"n": int(value)} if value != "text" else "no struct"

    inbox = tmp_path / "in"
    inbox.mkdir()
    kind = "struct<n:bigint>"
    for run, names in enumerate((("a", "b"), ("c", "d"))):
        for i, name in enumerate(names):
            put(spark, inbox, f"{name}.txt", [str(10 * run + i), "boom", "text", "x"])
        stream = sources.stream_lines(spark, str(inbox), max_files=1)
        assert consume.consume_each(stream, work, kind, place("out"), place("mark"), 120)
    fine = consume.worked(spark, place("out"), "value string", kind, False)
    assert sorted(r["result"]["n"] for r in fine.collect()) == [0, 1, 10, 11]
    assert fine.select("batch").distinct().count() == 4
    bad = consume.worked(spark, place("out"), "value string", kind, True).collect()
    assert len(bad) == 12 and {r["error"].split(":")[0] for r in bad if r["value"] == "boom"} == {"ValueError"}
    assert all(r["error"] for r in bad)


def test_task_stream(spark, place):
    tasks = sources.task_stream(spark, n=5, per_second=50)
    running_query = tasks.writeStream.format("memory").queryName("tasks").start()
    for _ in range(60):
        running_query.processAllAvailable()
        if spark.table("tasks").count() >= 5:
            break
        running_query.awaitTermination(1)
    running_query.stop()
    assert sorted(r["message"] for r in spark.table("tasks").collect()) == [f"Task #{i}" for i in range(5)]


def blobs(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, 120)
    x = np.where(label[:, None] == 1, 2.0, -2.0) + rng.normal(0, 0.6, (120, 2))
    return spark.createDataFrame(pd.DataFrame({"x": x[:, 0], "y": x[:, 1], "label": label, "id": range(120)}))


def test_online_perceptron(spark, place):
    learner = online.OnlinePerceptron(spark, [0, 1], ["x", "y"], "label", 2, place("weights"))
    for i in range(3):
        learner.update(blobs(spark, i), i)
    before = learner.weights()
    learner.update(blobs(spark, 9), 2)
    assert (learner.weights() == before).all()
    assert learner.state.history().agg(F.sum("rows")).first()[0] == 360
    assert accuracy(learner.classifier().predict(blobs(spark, 5)), "label", "prediction").first()[0] > 0.9


def test_online_study(spark, place):
    table = online.online_study(blobs(spark, 1), blobs(spark, 2), "id", ["x", "y"], "label", [0, 1], 2, place("study"), (0.25, 0.75), 2)
    rows = table.collect()
    assert rows[0]["rows"] < rows[1]["rows"] and rows[1]["accuracy"] > 0.9


def test_online_kmeans(spark, place):
    learner = online.OnlineKMeans(spark, ["x", "y"], 2, place("centres"), seed=1)
    for i in range(3):
        learner.update(blobs(spark, i), i)
    learner.update(blobs(spark, 3), 1)
    assert learner.counts().sum() == 360
    xs = sorted(c[0] for c in learner.fit().centres)
    assert xs[0] < -1 and xs[1] > 1
