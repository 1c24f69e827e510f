import random

from tokenizers import Tokenizer

import corpus_pipeline
from pyspark.sql import functions as F
from tallyloom.llm.queries import END_ID, token_file_path
from test_simhash import plain_classes, plain_print

LABELS = "doc_id long, quality int, toxic int"


def make(docs_of, folder_of, spark):
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))
    clean = [prose(rng.randint(60, 160)) for _ in range(150)]
    insults = ["vileword", "nastyterm"]
    toxic = []
    for _ in range(60):
        words = prose(100).split()
        for at in rng.sample(range(100), 8):
            words[at] = rng.choice(insults)
        toxic.append(" ".join(words))
    item = prose(30)
    leaks = [prose(50) + " " + item.upper() + ". " + prose(50) for _ in range(3)]
    texts = clean + toxic + leaks + clean[:20] + [c.replace(c.split()[40], "changed", 1) for c in clean[20:40]] + [None, ""]
    labels = [(i, 1, int(150 <= i < 210)) for i in range(210)]
    folder = folder_of(
        documents=docs_of([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)]),
        labels=spark.createDataFrame(labels, LABELS),
        benchmark=spark.createDataFrame([(0, item)], "item_id long, text string"),
    )
    return folder, texts


def test_stages(docs_of, folder_of, spark):
    folder, texts = make(docs_of, folder_of, spark)
    docs = start = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, folder))
        assert docs.columns == start.columns
        ids[name] = {r["doc_id"] for r in docs.collect()}
    clean, toxic, leaks = set(range(150)), set(range(150, 210)), {210, 211, 212}
    assert len(ids["toxicity"] & toxic) <= 3 and len(clean - ids["toxicity"]) <= 3
    assert {213 + i for i in range(20)} & ids["toxicity"], "copies reach the second stage"
    prints = {i: plain_print(texts[i]) for i in ids["toxicity"]}
    assert ids["simhash_near_dedup"] == {i for i, root in plain_classes(prints).items() if i == root}
    # A copy stays only where its original did not pass the first stage.
    assert {i - 213 for i in ids["simhash_near_dedup"] & set(range(213, 233))} <= clean - ids["toxicity"]
    assert ids["simhash_near_dedup"] - ids["benchmark_decontamination"] == leaks & ids["simhash_near_dedup"]


def test_run_gives_the_tokens_of_what_is_left(docs_of, folder_of, spark):
    folder, texts = make(docs_of, folder_of, spark)
    rows = sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda r: r["start"])
    tokenizer = Tokenizer.from_file(token_file_path())
    at = 0
    for r in rows:
        assert r["start"] == at
        assert r["n_tokens"] == len(tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [END_ID])
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


def test_without_labels_nothing_is_rejected(docs_of, folder_of, spark, odd):
    """No labels, no benchmark, clashing names, and empty tables."""
    docs = docs_of(odd).withColumns({c: F.lit("x") for c in ("score", "fingerprint", "root", "_k", "doc", "key")})
    none = spark.createDataFrame([], LABELS)
    items = spark.createDataFrame([], "item_id long, text string")
    folder = folder_of(documents=docs, labels=none, benchmark=items)
    kept = corpus_pipeline.cut_lineage(corpus_pipeline.toxic(spark, docs, folder))
    assert kept.columns == docs.columns and kept.count() == len(odd)
    left = corpus_pipeline.cut_lineage(corpus_pipeline.near_duplicates(spark, kept, folder))
    assert left.columns == docs.columns
    # 1 and 5 are copies of each other, as are the texts without a word.
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 1, 2, 7, 8]
    for stage in (corpus_pipeline.toxic, corpus_pipeline.near_duplicates, corpus_pipeline.benchmark_free, corpus_pipeline.mixed):
        assert stage(spark, docs.limit(0), folder).count() == 0
