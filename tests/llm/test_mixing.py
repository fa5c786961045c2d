from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import mixing

SCHEMA = "key long, source string, size long"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, cut = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in cut]
        level = (goal - sum(most * sizes[s] for s in cut)) / max(sum(weight[s] for s in rest), 1)
        above = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in cut else level * weight[s] for s in names}
        cut |= above


def plain_sainte_lague(votes, seats, limits):
    given = dict.fromkeys(votes, 0)
    for _ in range(seats):
        open_ = [k for k in votes if given[k] < limits[k]]
        best = max(open_, key=lambda k: (votes[k] / (2 * given[k] + 1), -list(votes).index(k)))
        given[best] += 1
    return given


def check(rows, found, slack):
    sizes, taken = defaultdict(int), Counter()
    for _, source, size in rows:
        sizes[source] += size
    targets = plain_targets(sizes)
    assert Counter((r.key, r.source, r.size) for r in found) == Counter(rows)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= slack, source


ROWS = [(k, f"s{k % 7}" if k % 3 else "hot", (k * 37) % 200) for k in range(900)] + [
    (1000, None, 50), (1001, "empty", 0), (None, "s1", 10), (5, "s5", 7), (5, "s5", 7), (1002, "one", 1), (1003, "", 3),
]


@pytest.mark.parametrize("shard_rows,slack", [(10_000, 8), (50, 8 * 20)])
def test_targets_and_shares(spark, shard_rows, slack):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    check(ROWS, mixing.mixed(df, shard_rows=shard_rows).collect(), slack)


def test_blocks_of_one_word_meet_targets_exactly(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    check(ROWS, mixing.mixed(df, block_words=1).collect(), 1)


def test_same_result_again_and_in_other_partitions(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    one = sorted(mixing.mixed(df.coalesce(1)).collect(), key=str)
    assert one == sorted(mixing.mixed(df.repartition(7)).collect(), key=str)
    assert one != sorted(mixing.mixed(df, seed=1).collect(), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "a", 0), (2, None, 0)], [(1, "a", 5)], [(1, "a", 1), (2, "b", 1000)]])
def test_small_tables(spark, rows):
    check(rows, mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect(), 8)


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 501])
def test_highest_quotients(spark, seats):
    votes = {f"k{n}": float(v) for n, v in enumerate([1, 1, 2, 3, 3, 50, 200, 0, 17])}
    limits = {k: 400 if v else 0 for k, v in votes.items()}
    df = spark.createDataFrame([(k, v, limits[k], seats) for k, v in votes.items()], "k string, votes double, cap long, seats long")
    found = mixing._apportioned(df, [], F.col("cap"), [F.col("k")], "given").collect()
    assert {r.k: r.given for r in found} == plain_sainte_lague(votes, seats, limits)


def test_sizes(spark):
    texts = [(1, None, "a"), (2, "", "a"), (3, "one\x0btwo\tthree four\xa0five", None), (4, "  ", "b")]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string")
    assert {r.key: r.size for r in mixing.sized(df).collect()} == {1: 0, 2: 0, 3: 4, 4: 0}


def test_query(spark):
    from sedimenta.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    import re

    rows = [(d.doc_id, d.source, len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))) for d in docs]
    source = {d.doc_id: d.source for d in docs}
    found = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.001").withColumnRenamed("doc_id", "key").collect()
    from types import SimpleNamespace

    check(rows, [SimpleNamespace(**r.asDict(), source=source[r.key]) for r in found], 8)


def test_repeated_rows_come_near_the_targets(spark):
    """One-document sources, one id on many rows, null ids, equal rows, texts without words."""
    rows = [(None if n % 3 == 0 else 7, " ".join(["w"] * (1 + n % 40)), f"s{n % 4}", n) for n in range(1200)]
    rows += [(1, "w " * 100_00, "single", 0), (2, "word", "z", 5), (2, "word", "z", 5), (2, "word", "z", 5), (3, None, "empty", 1), (4, " ", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _times int").repartition(4)
    found = mixing.repeated(df, shard_rows=100)
    assert found.columns == df.columns
    taken = [(r.source, len(r.text.split())) for r in found.collect()]
    sums = mixing.mixed(mixing.sized(df), shard_rows=100).groupBy("source").agg(F.first("target").alias("t"), F.max("size").alias("m")).collect()
    for row in sums:
        words = sum(n for source, n in taken if source == row.source)
        # a document per shard, of which there are 13
        assert abs(words - row.t) <= (row.m if row.source == "single" else 13 * row.m), row
        assert words > 0 or row.t == 0
    most = max(v for v in Counter((r.doc_id, r.text, r.source, r["_times"]) for r in found.collect()).values())
    assert most <= 6  # three equal rows, twice each
    assert mixing.repeated(df.limit(0)).collect() == []
