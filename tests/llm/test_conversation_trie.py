"""The prefix trie of rebuilt conversations against a plain one."""

import hashlib
import random
import zlib

import pytest

from ledgermill.llm import conversation_trie, scans

TURNS = "conv_id long, turn long, role string, text string"


def plain_nodes(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = convs.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, found in members.items():
        depth = len(prefix)
        below = [p for p in members if p[:depth] == prefix]
        ends = sorted(c for c in found if len(rebuilt[c]) == depth)
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        out.append(
            (
                min(found),
                depth,
                min(members[prefix[:-1]]) if depth else None,
                len(found),
                sum(len(p) == depth + 1 for p in below),
                len(childless),
                sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def found_nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_turns(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(700), n):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "bot"]), rng.choice(["é", "ab", "", "xyz"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_a_plain_trie(spark, seed):
    rows = random_turns(seed, 90)
    assert found_nodes(conversation_trie.prefix_nodes(spark.createDataFrame(rows, TURNS))) == plain_nodes(rows)


def test_a_long_conversation_and_many_copies(spark):
    long = [(7, k, "user", f"t{k % 5}") for k in range(120)] + [(8, k, "user", f"t{k % 5}") for k in range(110)]
    rows = long + [(c, k, "user", f"t{k}") for c in range(900, 960) for k in range(7)]
    got = found_nodes(conversation_trie.prefix_nodes(spark.createDataFrame(rows, TURNS).repartition(8)))
    assert got == plain_nodes(rows)


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, None, "", None), (1, 3, "user", "x"), (1, 3, "user", "x"), (None, 1, "user", "y")]
    rows += [(-5, 0, "a", "b"), (0, 5, "user", "x"), (205, 0, "user", "only"), (305, 0, None, "only"), (-105, 2, "a", "b")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], TURNS + ", depth int, product0 string")
    assert found_nodes(conversation_trie.prefix_nodes(df)) == plain_nodes(rows)
    none = conversation_trie.prefix_nodes(df.limit(0))
    assert none.count() == 0
    assert none.columns == (
        "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    )


def test_equal_fingerprints_of_different_prefixes_are_noticed(spark, monkeypatch):
    plain = conversation_trie.bases_of
    tried = []

    def weak_first(attempt):
        tried.append(attempt)
        return [(2, 5), (3, 7), (3, 7)] if attempt < 2 else plain(attempt)

    monkeypatch.setattr(conversation_trie, "bases_of", weak_first)
    rows = [(c, k, "user", f"{c * k}") for c in range(60) for k in range(6)]
    assert found_nodes(conversation_trie.prefix_nodes(spark.createDataFrame(rows, TURNS))) == plain_nodes(rows)
    assert tried == [0, 1, 2]


def test_end_ids_of_one_node_in_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 16)
    rows = [(c, 0, "user", "same") for c in range(100_000, 140_000, 100)]
    assert found_nodes(conversation_trie.prefix_nodes(spark.createDataFrame(rows, TURNS))) == plain_nodes(rows)


def test_running_products_across_partitions(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3]), k, rng.randrange(100)) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = scans.running(df, "k", [F.col("o")], ["v", "v"], [(1, None), (10, 1009)], "test").collect()
    state, want = {}, set()
    for k, o, v in sorted(rows):
        place, total, power, product = state.get(k, (0, 0, 1, 0))
        state[k] = (place + 1, total + v, power * 10 % 1009, (product * 10 + v) % 1009)
        want.add((k, o, v, state[k][0], 1, state[k][2], state[k][1], state[k][3]))
    assert {tuple(r) for r in got} == want


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found_nodes(conversation_trie.prefix_nodes(table)) == plain_nodes(rows)
