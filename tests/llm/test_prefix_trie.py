import hashlib
import random
import zlib
from collections import Counter, defaultdict

from compare import compare, connect
from pyspark.sql import functions as F

from tallyloom.llm import prefix_trie
from tallyloom.llm.prefix_trie import conversation_trie, rebuilt, numbered_turns
from tallyloom.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = (abs(c) - abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(lead, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    saved, leaves = Counter(), Counter()
    for node, m in members.items():
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * words
            leaves[node[:d]] += node not in kids
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), len(kids[node]) if node in kids else 0, leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversations(seed, n=130, most=9, words=("a", "b c", "", "d  e f")):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), -7, -20, -41, 10**12 + 3]:
        for t in range(rng.choice([0, 1, 1, 2, 3, most])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice([*words, None])))
    return rows


def check(got, rows):
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == plain_trie(plain_rebuilt(rows))


def test_query_against_plain_trie(spark, folder_of):
    rows = [*conversations(1), (None, 1, "user", "x"), (3, 1, None, "z" * 200_000)]
    folder = folder_of(conversations=spark.createDataFrame(rows, SCHEMA).repartition(3))
    check(QUERIES["op11_prefix_trie"](spark, folder).collect(), rows)


def test_query_against_sql(spark, folder_of):
    rows = [r for r in conversations(2)]
    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels".split()
    folder = folder_of(conversations=spark.createDataFrame(rows, SCHEMA), **{n: spark.range(1) for n in names})
    assert compare(QUERIES["op11_prefix_trie"], ORACLES["op11_prefix_trie"], spark, folder, connect(folder)) == []


def test_runs_of_a_few_rows_and_short_segments(spark, monkeypatch):
    """Nodes reach over runs, parts and segments; long lists of ends come in pieces."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for width, seed in ((1, 3), (2, 4), (3, 5)):
            rows = conversations(seed, 60, 17, ("a", "b c"))
            check(conversation_trie(spark.createDataFrame(rows, SCHEMA), width).collect(), rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_third_of_all_conversations_alike_and_one_of_a_third_of_all_turns(spark):
    rows = [(20 * c, t, "user", f"t{t}") for c in range(400) for t in range(2)]
    rows += [(20 * c, 0, "user", f"other {c}") for c in range(400, 700)] + [(9, t, "user", f"long {t % 5}") for t in range(900)]
    check(conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_odd_tables(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    # The only conversation keeps none of its turns if its number of leading turns exceeds them and the first one is absent.
    alone = next(c for c in range(1, 60) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(alone, 0, "user", "x y")]
    got = conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["depth"], r["n_convs"], r["n_leaves"]) for r in got] == [(0, 1, 1)]
    check(got, rows)
    clashing = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("at", "seg", "key", "p1", "words", "id")})
    check(conversation_trie(clashing).collect(), rows)


def test_general_heads_and_families(spark):
    rows = [(c, t, "u", f"{c}-{t}") for c in range(8) for t in range(3)]
    convs, turns = rebuilt(numbered_turns(spark.createDataFrame(rows, SCHEMA)), family=4, heads=3)
    assert convs.count() == 8
    for c, size in turns.groupBy("conv_id").count().collect():
        assert size == 3
