from collections import defaultdict

from compare import compare, connect
from pyspark.sql import functions as F

from tallyloom.llm.digest_index import DigestIndex, dedup_newest_first, drop_copies
from tallyloom.llm.queries import ORACLES, QUERIES
from tallyloom.session import scratch_path


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    """keep id and size of each text."""
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[lowered(t)].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_query_against_plain_groups(docs_of, folder_of, spark, odd):
    rows = [*odd, (9, "ONE", "a"), (10, "Äh", "a"), (11, "äh", "a"), (12, "x" * 300_000, "b"), (3, "X" * 300_000, "b"), (-5, "one", "c")]
    rows += [(100 + i, "Copy", "hot") for i in range(200)]
    got = QUERIES["op13_exact_dedup"](spark, folder_of(documents=docs_of(rows))).collect()
    want = plain(rows)
    text_of = {(i, lowered(t)) for i, t, _ in rows}
    assert len(got) == len(rows)
    by_text = defaultdict(list)
    import hashlib

    names = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
    for r in got:
        t = names[r["text_sha256"]]
        assert (r["doc_id"], t) in text_of
        assert (r["keep_id"], r["group_size"]) == want[t]
        by_text[t].append(r)
    for t, group in by_text.items():
        stays = [r for r in group if r["kept"]]
        assert len(stays) == 1 and stays[0]["doc_id"] == want[t][0] and len(group) == want[t][1]


def test_query_against_sql(docs_of, folder_of, spark):
    rows = [(i, f"Text {i % 7}" if i % 3 else f"text {i % 11}", "a") for i in range(120)] + [(500, None, "a"), (501, "", "b")]
    names = "region nation customer supplier part orders lineitem events embeddings pages benchmark labels conversations".split()
    folder = folder_of(documents=docs_of(rows), **{n: spark.range(1) for n in names})
    assert compare(QUERIES["op13_exact_dedup"], ORACLES["op13_exact_dedup"], spark, folder, connect(folder)) == []


def test_empty_table_and_null_ids(docs_of):
    assert dedup_newest_first(docs_of([])).count() == 0
    rows = dedup_newest_first(docs_of([(None, "a", "s"), (None, "A", "s"), (None, None, "s")])).collect()
    assert sorted(r["group_size"] for r in rows) == [1, 2, 2] and sum(r["kept"] for r in rows) == 2


def test_arrivals_and_a_new_session_see_the_index(docs_of, spark):
    folder = scratch_path(spark, "index")
    index = DigestIndex.opened(spark, folder, 4)
    first = drop_copies(docs_of([(1, "a", "s"), (2, "A", "s"), (3, "b", "s")]), index)
    assert sorted(r["doc_id"] for r in first.collect()) == [2, 3]
    index.close()
    again = DigestIndex.opened(spark, folder, 4)
    second = docs_of([(4, "B", "s"), (5, "c", "s"), (5, "c", "s"), (6, None, "s")]).withColumns({"digest": F.lit(1), "row": F.lit("x"), "doc": F.lit(2)})
    kept = drop_copies(second, again)
    assert kept.columns == second.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 6]
    assert again.rows().count() == 4
    # The same arrival once more adds nothing.
    assert drop_copies(second, again).count() == 0 and again.rows().count() == 4
    again.close()


def test_no_row_of_the_index_moves(docs_of, spark):
    index = DigestIndex.opened(spark, scratch_path(spark, "index"), 4)
    drop_copies(docs_of([(1, "a", "s")]), index)
    new = spark.createDataFrame([(b"x", 1, 2)], "digest binary, doc_id long, row long")
    plan = index.unseen(new)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    index.close()
