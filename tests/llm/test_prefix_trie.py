import hashlib
import random
import re
import zlib

import duckdb
import pytest

from retailweave.llm.oracles import ORACLES
from retailweave.llm.prefix_trie import common_length, digests, merged, prefix_trie, turn_keys
from retailweave.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"


def brute_force(conversations):
    """Rows of the trie of ``{id: [(role, text), ...]}``, from all prefixes."""
    members = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, own in members.items():
        inside, at = [p], 0
        while at < len(inside):
            inside += children.get(inside[at], [])
            at += 1
        ends = sorted(conv for conv, turns in conversations.items() if tuple(turns) == p)
        out.append(
            (
                min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children.get(p, [])),
                sum(q not in children for q in inside),
                sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in inside if q),
                ends,
            )
        )
    return sorted(out, key=repr)


def trie_rows(spark, conversations, block_turns=1 << 17, partitions=None, df=None):
    rows = [(conv, i, role, text) for conv, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4) if df is None else df
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = prefix_trie(turn_keys(df), spark.createDataFrame([(conv,) for conv in conversations], "conv long"), block_turns)
        nodes, ends = found.nodes.collect(), found.ends.collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    at = {}
    for row in ends:
        at.setdefault(bytes(row.key), []).append(row.conv)
    out = []
    for row in nodes:
        own = sorted(at.pop(bytes(row.key))) if row.key is not None else []
        out.append((row.conv, row.depth, row.parent_conv, row.n_convs, row.n_children, row.n_leaves, row.saved_tokens, own))
    assert not at
    return sorted(out, key=repr)


def made(seed, n=120, words=3, longest=7):
    chance = random.Random(seed)
    turns = [(role, text) for role in ("user", "assistant") for text in ["", "a b", "c\td  e"][:words]]
    return {conv * 3 - 40: [chance.choice(turns) for _ in range(chance.randint(0, longest))] for conv in range(n)}


@pytest.mark.parametrize("partitions", [1, 7, 60])
@pytest.mark.parametrize("block_turns", [1, 9, 1 << 17])
def test_equals_all_prefixes_whatever_the_bounds(spark, partitions, block_turns):
    conversations = made(partitions * 100 + block_turns)
    assert trie_rows(spark, conversations, block_turns, partitions) == brute_force(conversations)


@pytest.mark.parametrize("partitions", [1, 5])
def test_chains_copies_and_lonely_paths(spark, partitions):
    long = [("user", f"turn {i}") for i in range(60)]
    conversations = {i: long[: i % 61] for i in range(130)} | {200 + i: long for i in range(50)} | {300: [], 301: [("x", "y")]}
    conversations |= {400 + i: long[:30] + [("user", f"other {i}")] + long[:3] for i in range(40)}
    assert trie_rows(spark, conversations, 50, partitions) == brute_force(conversations)


@pytest.mark.parametrize("conversations", [{}, {5: []}, {5: [], -7: []}, {1: [("a", "b")]}])
def test_few_conversations(spark, conversations):
    assert trie_rows(spark, conversations) == brute_force(conversations)


def test_nulls_ties_repeats_and_clashing_columns(spark, clashing):
    rows = [
        (1, 0, None, None), (1, 1, "user", "x"), (2, 0, "", ""), (2, 1, "user", "x"), (2, 1, "user", "x"), (3, None, "b", "n"),
        (3, None, "a", "n"), (3, -1, "user", "x"), (None, 0, "user", "x"), (4, 0, "us", "erx"),
    ]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "key", "conv", "tokens", "entry", "path", "depth")
    x, nothing = ("user", "x"), ("", "")
    conversations = {1: [nothing, x], 2: [nothing, x, x], 3: [("a", "n"), ("b", "n"), x], 4: [("us", "erx")]}
    assert trie_rows(spark, conversations, df=df) == brute_force(conversations)


def test_merges_in_descending_depth_make_the_branching_nodes():
    # aa, aab, aac, ad, b as neighbours
    depth, parent, children, first, last = (x.tolist() for x in merged(*map(__import__("numpy").array, ([2, 3, 3, 2, 1], [0, 2, 2, 1, 0]))))
    assert depth == [2, 3, 3, 2, 1, 1, 0] and parent == [5, 0, 0, 5, 6, 6, -1]
    assert children[0] == 2 and children[5] == 2 and children[6] == 2 and (first[5], last[5]) == (0, 3)


def test_common_length_counts_whole_keys():
    a, b = b"x" * 16, b"y" * 16
    assert [common_length(p, q) for p, q in ((b"", a), (a, a + b), (a + a, a + b), (b, a), (a[:15] + b"z" + b, a + b))] == [0, 1, 1, 0, 0]


def test_digests_follow_the_order_of_numbers(spark):
    rows = [(b"k", i * 7 % 1009 - 300) for i in range(1009)] + [(b"one", 5), (b"two", 10), (b"two", 9)]
    ends = spark.createDataFrame(rows, "key binary, conv long").repartition(5)
    wanted = {}
    for key, conv in sorted(rows):
        wanted.setdefault(key, []).append(str(conv))
    found = {bytes(row.key): row.sha256 for row in digests(ends).collect()}
    assert found == {key: hashlib.sha256(",".join(convs).encode()).hexdigest() for key, convs in wanted.items()}
    assert digests(ends.limit(0)).collect() == []


def test_query_equals_sql_and_brute_force(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    found = op11_prefix_trie(spark, path.rpartition("/")[0]).toArrow()
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    wanted = connection.sql(ORACLES["op11_prefix_trie"]).to_arrow_table()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found.column_names == names
    assert sorted(map(repr, found.to_pylist())) == sorted(map(repr, wanted.select(names).to_pylist()))
    rows = sorted(((r.conv_id, r.turn, r.role or "", r.text or "") for r in spark.read.parquet(path).collect()))
    own = {}
    for conv, _, role, text in rows:
        own.setdefault(conv, []).append((role, text))
    heads = {conv: zlib.crc32(str(conv).encode()) % 4 for conv in own}
    rebuilt = {conv: own.get(conv - conv % 20, [])[:h] + own[conv][h:] for conv, h in heads.items()}
    expected = [(*row[:7], hashlib.sha256(",".join(map(str, row[7])).encode()).hexdigest()) for row in brute_force(rebuilt)]
    assert sorted(map(repr, (tuple(row.values()) for row in found.to_pylist()))) == sorted(map(repr, expected))


def test_query_equals_sql_on_odd_white_space_and_few_turns(spark, tmp_path):
    texts = ["a\rb", "a\x0bb\x0cc", "a\u00a0b", "\r\n", "a\tb  c", "", None]
    rows = [(conv, turn, "user", texts[(conv * 3 + turn) % len(texts)]) for conv in range(45) if conv != 20 for turn in range(conv % 6)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    found = op11_prefix_trie(spark, str(tmp_path)).toArrow()
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    wanted = connection.sql(ORACLES["op11_prefix_trie"]).to_arrow_table().select(found.column_names)
    assert sorted(map(repr, found.to_pylist())) == sorted(map(repr, wanted.to_pylist()))
