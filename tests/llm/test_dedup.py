import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sedimenta.llm import exact_dedup, simhash
from sedimenta.llm.common import staged


def plain_groups(rows, keep):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    chosen = {t: (keep([k for k in ks if k is not None], default=None), len(ks)) for t, ks in groups.items()}
    return sorted(((k, *chosen[t or ""]) for k, t in rows), key=str)


ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "a "), (7, "x" * 200_000), (8, "x" * 200_000), (9, "é"),
        (10, "é"), (None, "a"), (None, "only null"), (2, "a"), (11, "\x00"), (12, "\x00\x00")]


@pytest.mark.parametrize("keep,plain", [("smallest", min), ("largest", max)])
def test_exact_groups(spark, keep, plain):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    found = exact_dedup.duplicates(df, keep=keep).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == plain_groups(ROWS, plain)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_exact_hot_group_is_split_and_whole(spark):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup.duplicates(df)
    assert found.count() == 4000
    assert found.filter("group_size = 1334 and keep_id = 0").count() == 1334
    assert found.filter("kept").count() == 4000 - 1333


def test_exact_deduplicated_keeps_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", 7), (2, "a", "y", 8), (3, None, None, None), (1, "a", "x", 7), (1, "b", "z", 0)],
        "doc_id long, text string, _hash string, _salt long",
    )
    found = exact_dedup.deduplicated(df)
    assert found.columns == df.columns
    assert sorted(found.collect(), key=str) == sorted(
        [(1, "a", "x", 7), (3, None, None, None), (1, "b", "z", 0)], key=str
    )
    assert exact_dedup.deduplicated(df.limit(0)).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, distance):
    keys = list(fingerprints)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= distance:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in keys}


def test_fingerprints(spark):
    texts = [None, "", " \n", "one", "One two", "a b c", "A B C", "É b c d e f", "x " * 5000, "a\x0bb\x1cc d e", "日本 語 テ キ"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in simhash.fingerprints(df).collect():
        assert row.fingerprint & (1 << 64) - 1 == plain_fingerprint(row.text), row.text


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance,bucket", [(2, 64), (2, 8), (3, 16), (1, 64), (0, 64)])
def test_components_match_all_pairs(spark, distance, bucket, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (2, bucket))
    random.seed(distance)
    values = [0, (1 << 64) - 1, 1, 7]
    for _ in range(60):
        value = random.getrandbits(64)
        for _ in range(6):
            values.append(value)
            value ^= sum({1 << random.randrange(64) for _ in range(random.randrange(5))})
    for k in range(64):  # a dense ball, which no single bucket holds apart
        values.append(1 << k | 1 << (k * 7 + 3) % 64)
    fingerprints = dict(enumerate(values))
    df = spark.createDataFrame([(k, signed(v)) for k, v in fingerprints.items()], "doc_id long, fp long")
    found = {r.doc_id: r.component_id for r in simhash.components(df, "fp", distance=distance).collect()}
    assert found == plain_components(fingerprints, distance)


def test_plan_fulfils_the_pigeonhole_principle(spark):
    nodes = staged(spark.range(2000).select(F.xxhash64("id").alias("fp")))
    for distance in (0, 1, 2, 5):
        masks, thresholds = simhash.plan(nodes, distance)
        assert sum(masks) == (1 << 64) - 1 and all(a & b == 0 for a in masks for b in masks if a != b)
        assert sum(thresholds) == distance - len(masks) + 1


def test_cheapest_thresholds_are_unequal_where_costs_are():
    total, chosen = simhash._cheapest([[1.0, 50.0, 900.0], [30.0, 40.0, 900.0], [2.0, 60.0, 900.0]], 0)
    assert (total, chosen) == (33.0, [0, 0, 0])
    assert simhash._cheapest([[1.0, 2.0], [90.0, 99.0], [3.0, 9.0]], 0)[1] == [1, -1, 0]
    assert simhash._cheapest([[5.0, 7.0], [6.0, 6.5]], 1)[1] == [0, 1]


def test_correlated_bits_share_a_partition():
    correlation = np.eye(64)
    for a, b in ((0, 63), (5, 40), (7, 50)):
        correlation[a, b] = correlation[b, a] = 0.9
    groups = simhash._grouped(correlation, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert all(any(a in g and b in g for g in groups) for a, b in ((0, 63), (5, 40)))


def test_near_deduplicated(spark):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(5, text, "a"), (3, text + " end", "b"), (9, "other words here", "c"), (None, "", "d"), (2, None, "e"), (9, "other words here", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    near = (plain_fingerprint(rows[0][1]) ^ plain_fingerprint(rows[1][1])).bit_count() <= 2
    found = sorted(r.doc_id for r in simhash.near_deduplicated(df).collect())
    assert found == ([2, 3, 9] if near else [2, 3, 5, 9])
    assert simhash.near_deduplicated(df).columns == df.columns
    assert simhash.near_deduplicated(df.limit(0)).collect() == []


def test_near_deduplicated_with_repeated_and_null_keys(spark):
    def text(n):
        return " ".join(f"t{n}w{k}" for k in range(40))

    stay = [(1, text(1), "a"), (1, text(2), "b"), (None, text(3), "a"), (None, text(4), "b"), (3, text(5), "a"), (5, text(6), "b")]
    go = [(5, text(5), "b"), (None, text(5), "c"), (None, text(6), "c")]
    prints = [plain_fingerprint(r[1]) for r in stay]
    assert all((a ^ b).bit_count() > 2 for k, a in enumerate(prints) for b in prints[:k])
    df = spark.createDataFrame([*stay, *go, stay[0], stay[2]], "doc_id long, text string, source string").repartition(3)
    found = simhash.near_deduplicated(df)
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(stay, key=str)
    # many null keys, each with a text of its own
    many = spark.range(60).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "concat_ws(' ', transform(sequence(0, 30), x -> concat('d', id, 'w', x))) AS text")
    prints = [plain_fingerprint(r.text) for r in many.collect()]
    assert len(set(plain_components(dict(enumerate(prints)), 2).values())) == 60
    assert simhash.near_deduplicated(many).count() == 60


def test_simhash_query(spark):
    from sedimenta.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    fingerprints = {k: plain_fingerprint(t) for k, t in texts.items()}
    expected = plain_components(fingerprints, 2)
    rows = QUERIES["op10_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        k: (f"{fingerprints[k]:016x}", expected[k]) for k in texts
    }
