import hashlib
import random
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import conversation_trie as ct

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_conversations(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, digest, len(text.split())))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in found.items()}


def plain_trie(convs):
    nodes, ends, words = {}, {}, {}
    for c, turns in convs.items():
        path = ()
        nodes.setdefault(path, set()).add(c)
        words[path] = 0
        for digest, w in turns:
            path += (digest,)
            nodes.setdefault(path, set()).add(c)
            words[path] = w
        ends.setdefault(path, []).append(c)
    children = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}
    result = []
    for path, members in nodes.items():
        below = [q for q in nodes if q[: len(path)] == path]
        last = ",".join(map(str, sorted(ends.get(path, []))))
        result.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children[path]),
            sum(not children[q] for q in below), sum((len(nodes[q]) - 1) * words[q] for q in below),
            hashlib.sha256(last.encode()).hexdigest(),
        ))
    return sorted(result, key=str)


def frame(spark, rows):
    rows = [(*row, "x", b"y") for row in rows]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, digest binary").repartition(3)


def random_rows(seed, convs, letters="abc", longest=6):
    rng = random.Random(seed)
    return [
        (c, turn, rng.choice(["user", "user", None]), rng.choice([None, *letters]) and " ".join(rng.choice(letters) * rng.randint(1, 2)))
        for c in range(convs) for turn in range(rng.randint(1, longest))
    ]


def test_findclose():
    rng = random.Random(2)
    for size in (1, 2, 40, 3000):
        bits, depth = [], 0
        while len(bits) + depth < 2 * size:
            up = depth == 0 and bits == [] or (depth > 1 and rng.random() < 0.52) or depth == 1
            bits.append(up)
            depth += 1 if up else -1
        bits += [False] * depth
        stack, expected = [], {}
        for k, up in enumerate(bits):
            if up:
                stack.append(k)
            else:
                expected[stack.pop()] = k
        for block in (2, 8, 64):
            tree = ct.Parentheses(np.array(bits), block)
            opens = np.array(sorted(expected))
            closes = tree.findclose(opens)
            assert closes.tolist() == [expected[k] for k in sorted(expected)]
            empty = [k for k in expected if expected[k] == k + 1]
            assert tree.leaves(opens, closes).tolist() == [sum(o <= k < expected[o] for k in empty) for o in sorted(expected)]


@pytest.mark.parametrize("shard_turns", [1, 7, 60, 100_000])
def test_trie(spark, shard_turns):
    rows = random_rows(shard_turns, 90) + [(500 + k, t, "user", "hot text") for k in range(70) for t in (3, 4)]
    rows += [(10_000_000 + k, 0, "user", "hot text") for k in range(3)] + [(70_000 * k, 5, "user", "far") for k in range(1, 5)]
    found = ct.trie(ct.conversations(frame(spark, rows)), shard_turns)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie(plain_conversations(rows))


def test_long_conversations_and_many_ranges(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(4) for t in range(700 + c)] + random_rows(4, 60, "ab", 9)
    rows = [(c + 1000 * (len(text or "") > 5), t, role, text) for c, t, role, text in rows]
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        found = ct.trie(ct.conversations(frame(spark, rows)), 50)
        expected = plain_trie(plain_conversations(rows))
        assert sorted(map(tuple, found.collect()), key=str) == expected and len(expected) > 700
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_order_nulls_and_ties(spark):
    rows = [(1, None, None, None), (1, 2, "user", "b"), (1, 1, "user", "a"), (2, 1, "user", "a"), (2, 2, "user", "b"), (2, None, "", ""),
            (3, 1, "user", "z y"), (3, 1, "user", "c"), (3, 1, "user", "c"), (None, 1, "user", "lost"), (-5, 0, "us", "era"), (-4, 0, "use", "ra")]
    found = ct.trie(ct.conversations(frame(spark, rows)))
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie(plain_conversations(rows))
    assert ct.trie(ct.conversations(frame(spark, rows).limit(0))).collect() == []


def test_branched(spark):
    rows = random_rows(9, 130) + [(203, 0, "user", "alone"), (245, 0, "user", "base is missing"), (245, 1, "user", "own")]
    convs = plain_conversations(rows)

    def rebuilt(c):
        h = crc32(str(c).encode()) % 4
        return convs.get(c - c % 20, [])[:h] + convs[c][h:]

    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 4
    found = ct.branched(ct.conversations(frame(spark, rows)), conv - conv % 20, shared, 3).collect()
    assert {r.conv_id: [(t.digest, t.words) for t in r.turns] for r in found} == {c: rebuilt(c) for c in convs}
    assert any(not r.turns for r in found)


def test_query_equals_sql(spark):
    from sedimenta.llm.queries import ORACLE_SQL, QUERIES

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    expected = con.execute(ORACLE_SQL["op12_conversation_trie"])
    names = [x[0] for x in expected.description]
    assert sorted(names) == sorted(COLUMNS)
    found = QUERIES["op12_conversation_trie"](spark, folder).select(*names).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected.fetchall(), key=str)
    assert sum(r.n_convs > 1 for r in found) > 3
