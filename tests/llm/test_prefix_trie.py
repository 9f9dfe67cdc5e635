"""The prefix trie against its SQL, on odd tables and in many small shards."""

import random

import pytest

from barlake.llm import prefix_trie
from barlake.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_mixing import same

SQL = ORACLE_SQL["op11_prefix_trie"]
SCHEMA = "conv_id long, turn long, role string, text string, id string, depth int, n_convs int, level string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def test_trie_query(spark, sf_small):
    same(QUERIES["op11_prefix_trie"](spark, sf_small), SQL, conversations=f"{sf_small}/conversations.parquet")


ODD = [(c, t, "user" if t % 2 == 0 else None, f"turn {t}" if t < 3 else None) for c in range(40) for t in range(c % 7)]
ODD += [(100, None, "user", "first"), (100, 0, "user", "second"), (100, 0, "user", "a tie"), (100, 0, "user", "a tie"), (101, 5, "", "")]
ODD += [(None, 0, "user", "nobody"), (-7, 0, "user", "x"), (-7, 1, "a", "é\U0001f600"), (-100, 0, "user", "y"), (305, 0, "only", "own"), (306, 0, "a", "b")]


@pytest.mark.parametrize("shard, limit, piece", [(200_000, 100_000, 1 << 14), (7, 2, 5)])
def test_trie_odd_rows(spark, tmp_path, shard, limit, piece):
    df = frame(spark, ODD)
    df.write.parquet(f"{tmp_path}/c")
    rows = same(prefix_trie.prefix_trie(df, shard, limit, piece).drop("id"), SQL, conversations=f"{tmp_path}/c/*.parquet")
    assert [r["parent_conv_id"] for r in rows if r["depth"] == 0] == [None]


def test_trie_of_copies_and_a_long_conversation(spark, tmp_path):
    """Most conversations are copies of each other, one holds most rows."""
    rng = random.Random(3)
    rows = [(c, t, "user", f"shared {t}") for c in range(60) for t in range(5)]
    rows += [(1000 + c, t, "user", rng.choice("ab")) for c in range(80) for t in range(7)]
    rows += [(2000, t, "user", f"long {t}") for t in range(1500)] + [(2001, t, "user", f"long {t}") for t in range(900)]
    df = frame(spark, rows).repartition(5)
    df.write.parquet(f"{tmp_path}/c")
    same(prefix_trie.prefix_trie(df, 40, 8, 20).drop("id"), SQL, conversations=f"{tmp_path}/c/*.parquet")


def test_trie_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []


def test_queue_spills_and_keeps_the_order():
    rng = random.Random(5)
    queue, sent = prefix_trie.SpillingQueue(4), {}
    for n in range(200):
        key = (rng.randrange(20), bytes([rng.randrange(3)]))
        queue.push(key, (n, None if n % 2 else (n,)))
        sent.setdefault(key, []).append(n)
        assert len(queue.heap) <= 4
    for key in sorted(sent):
        assert sorted(n for n, _ in queue.take(key)) == sent[key]
    assert not queue.heap and not queue.heads
