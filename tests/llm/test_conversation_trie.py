import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from flowgauge.llm import conversation_trie
from flowgauge.llm.queries import ORACLES, QUERIES
from tests.compare import assert_same, connect
from tests.conftest import DATA
from tests.llm.brute import words

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            id = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), id, role, text))
    own = {conv: [(role, text) for _, _, role, text in sorted(turns)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(convs):
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node."""
    members = defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(held) - 1) * len(words(node[-1][1])) if node else 0
    ends = {node: ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(node)) for node, held in members.items()}
    return [
        (min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children[node], leaves[node],
         saved[node], hashlib.sha256(ends[node].encode()).hexdigest())
        for node, held in members.items()
    ]


def found(turns):
    rows, convs = conversation_trie.branched(conversation_trie.turns_in_order(turns))
    return [tuple(r) for r in conversation_trie.prefix_trie(rows, convs).collect()]


def assert_trie(spark, rows):
    rows = list(rows)
    random.Random(1).shuffle(rows)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want = trie(rebuilt(rows))
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(got, key=order) == sorted(want, key=order)
    return got


@pytest.fixture(params=["as registered", "small spans"])
def spans(request, monkeypatch):
    if request.param == "small spans":
        monkeypatch.setattr(conversation_trie, "SPAN", 2)
        monkeypatch.setattr(conversation_trie, "CHUNK_BITS", 1)


def test_the_twin(spark):
    name = "op13_conversation_trie"
    assert_same(QUERIES[name](spark, DATA).toPandas(), connect(DATA).execute(ORACLES[name]).df())


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert_trie(spark, rows)


def test_random_branches(spark, spans):
    """Conversations over a few turns, so that prefixes of all lengths are shared, many copies among them."""
    rng = random.Random(7)
    rows = []
    for conv in rng.sample(range(-50, 400), 150):
        shared = rng.choice([0, 3, 9, 17, 30])
        said = ["a b", "c", ""][rng.randrange(3)]
        rows += [(conv, t, "user", said) for t in range(shared)]
        rows += [(conv, shared + t, rng.choice("xy"), rng.choice(["u", "v w"])) for t in range(rng.randrange(4))]
    got = assert_trie(spark, rows)
    assert max(x[1] for x in got) >= 30 and max(x[3] for x in got if x[1] >= 9) > 1


def test_a_conversation_of_a_third_of_all_rows(spark, spans):
    long = [(20, t, "user", f"turn {t % 7}") for t in range(150)]
    copy = [(40, t, "user", f"turn {t % 7}") for t in range(150)]
    others = [(100 + c, t, "user", f"turn {t}") for c in range(40) for t in range(4)]
    assert_trie(spark, long + copy + others)


def test_copies_that_end_together(spark, spans):
    """Conversations with ids divisible by 20 stay as they are: all end at one node, hashed over many ranges."""
    rows = [(20 * c, t, "user", f"turn {t}") for c in range(-300, 300) for t in range(2)]
    got = assert_trie(spark, rows)
    assert len(got) == 3


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (20, None, "user", "null first"), (20, 1, None, None), (20, 1, "", ""),
        (20, 1, "user", "tie"), (20, 1, "assistant", "tie"), (20, 2, "user", "twice"), (20, 2, "user", "twice"),
        (21, 0, "us", "er"), (22, 0, "user", ""), (23, 5, "user", "alone"), (2**62, 1, "a", "b"), (-21, 0, "a", "b c"),
        (-20, 3, "a", "b"), (81, 0, "u", "base is absent"), (20, 9, "user", "\t a \n b " * 50_000),
        *((c, 0, "u", "x") for c in range(200, 240)),
    ]
    got = assert_trie(spark, rows)
    assert any(h for *_, h in got)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "u", "x") for c in range(1, 20)]
    got = assert_trie(spark, rows)
    root = next(x for x in got if x[1] == 0)
    turnless = [c for c, turns in rebuilt(rows).items() if not turns]
    assert turnless and root[3] == 19 and root[7] == hashlib.sha256(",".join(map(str, turnless)).encode()).hexdigest()


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []


def test_clashing_names_and_other_types(spark):
    rows = spark.createDataFrame([(20, 1, "a", "b", 1, 2), (40, 1, "a", "b", 3, 4)], "conv_id int, turn int, role string, text string, depth int, conv int")
    got = found(rows.withColumnRenamed("text", "id"). withColumnRenamed("id", "text"))
    assert sorted(x[:4] for x in got) == [(20, 0, None, 2), (20, 1, 20, 2)]


def test_one_rollup_covers_all_blocks(spark):
    """The plan does not grow with the length of conversations."""
    def jobs(length):
        rows = spark.createDataFrame([(20, t, "u", f"{t}") for t in range(length)], SCHEMA)
        held, convs = conversation_trie.branched(conversation_trie.turns_in_order(rows))
        plan = conversation_trie.prefix_trie(held, convs)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join")

    assert jobs(3) == jobs(100)
