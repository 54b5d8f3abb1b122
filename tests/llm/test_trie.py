import hashlib
import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harness.check import oracle_connection
from harness.check import rows as sorted_rows
from smeltworks.llm import conversation_trie, queries
from smeltworks.llm.conversation_trie import Tree, _middle_first, prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def digest(row):
    role, text = row["role"] or "", row["text"] or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    """The nodes by definition, from dictionaries of whole prefixes."""
    grouped = {}
    for r in rows:
        if r["conv_id"] is not None:
            grouped.setdefault(r["conv_id"], []).append(r)
    original = {
        c: [(r["role"] or "", r["text"] or "") for r in sorted(v, key=lambda r: (r["turn"] is not None, r["turn"] or 0, digest(r)))]
        for c, v in grouped.items()
    }
    members, ends = {}, {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        turns = original.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved, out = {}, {}, {}, []
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = sum(saved[x] for x in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        ids = ",".join(map(str, sorted(ends.get(p, []))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(below), leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_turns(seed):
    """Nulls everywhere, ties of turns, repeated rows, negative ids, texts that differ only in their role."""
    rng = random.Random(seed)
    ids = [None, -250, -200, -1, 5, 7, 8, 9, 100, 101, 102, 103, 107, 108, 200, 201]
    rows = [(rng.choice(ids), rng.choice([None, *range(1, 9)]), rng.choice([None, "user", "bot"]), rng.choice([None, "", "x", "yy", "é" * 3])) for _ in range(150)]
    return [*rows, rows[0], rows[1]]


@pytest.mark.parametrize("shard_turns, piece_chars", [(conversation_trie.SHARD_TURNS, conversation_trie.PIECE_CHARS), (20, 8)])
def test_nodes_equal_brute_force(spark, shard_turns, piece_chars):
    df = spark.createDataFrame(odd_turns(3), TURNS)
    assert found(prefix_trie(df, shard_turns, piece_chars)) == brute(df.collect())


def test_copies_in_many_shards_have_one_node(spark):
    """A third of all conversations are equal: their members are spread over partitions and pieces."""
    rows = [(100 * c, t, "user", "same" if c % 3 else f"own {c} {t}") for c in range(900) for t in range(4)]
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    got = found(prefix_trie(df, 50, 64))
    assert got == brute(df.collect()) and max(r[3] for r in got if r[1] == 4) == 600


def test_long_conversations_and_texts(spark):
    rows = [(300 + c, t, "user", f"{t}") for c in range(3) for t in range(3000)] + [(400, 0, "user", "word " * 200_000)]
    df = spark.createDataFrame(rows, TURNS)
    assert found(prefix_trie(df, 1000)) == brute(df.collect())


def test_clashing_columns_and_no_rows(spark):
    df = spark.createDataFrame(odd_turns(4), TURNS)
    names = ["base", "digest", "chars", "kind", "shard", "at", "head", "turns", "depth"]
    assert found(prefix_trie(df.withColumns({n: F.lit("z") for n in names}))) == brute(df.collect())
    assert prefix_trie(df.where("false")).isEmpty() and prefix_trie(df.where("conv_id IS NULL")).isEmpty()


def test_query_equals_sql(spark, sf):
    name = "op11_ternary_conversation_trie"
    df, result = queries.queries()[name](spark, sf), oracle_connection(sf).sql(queries.oracle_sql()[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(result.columns, result.fetchall())


@given(st.lists(st.lists(st.integers(0, 5), max_size=6), max_size=40))
@settings(deadline=None, max_examples=100)
def test_tree_holds_every_prefix_once(sequences):
    tree = Tree()
    ends = {tuple(s): tree.insert(s, [1] * len(s)) for s in sequences}
    assert len(tree.key) == len({tuple(s[:i]) for s in sequences for i in range(1, len(s) + 1)}) + 1
    for s, node in ends.items():
        path = []
        while node:
            path.append(tree.key[node])
            node = tree.parent[node]
        assert path[::-1] == list(s)


def test_median_insertion_balances_siblings():
    n, tree = 1023, Tree()
    order = list(_middle_first(n))
    assert sorted(order) == list(range(n))
    for i in order:
        tree.insert([i], [1])
    height, level = 0, [tree.down[0]]
    while level:
        height += 1
        level = [x for node in level for x in (tree.left[node], tree.right[node]) if x >= 0]
    assert height == 10
