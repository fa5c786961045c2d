import re

import numpy as np
import pytest

from sedimenta.llm import licenses, toxicity

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"  # noqa: E501
FILLER = " ".join(f"filler{n}" for n in range(500))


def plain_words(text):
    return re.findall(r"[^\W_]+", text.lower())


def plain_shingles(text, length=5):
    words = plain_words(text)
    return {tuple(words[k : k + length]) for k in range(max(len(words) - length + 1, min(len(words), 1)))}


def test_scan(spark):
    short = "Released under the MIT License."
    changed = MIT.replace("free of charge", "at no cost")  # loses few of its shingles
    rows = [
        (1, f"{FILLER} {short} {FILLER}"), (2, short), (3, f"{FILLER}\n{MIT.upper()}\n{FILLER}"), (4, changed),
        (5, " ".join(MIT.split()[:12])), (6, FILLER), (7, None), (8, ""), (None, short), (2, short),
        (9, f"{short} {FILLER} Licensed under CC BY-NC 4.0."), (10, f"{short} " * 2000),
        (11, "released under the mit"), (12, "MIT the under License. Released"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = licenses.scanned(df, licenses.templates(spark)).collect()
    assert sorted(((r.doc_id, r.license) for r in found), key=str) == sorted(
        [(1, "MIT"), (2, "MIT"), (3, "MIT"), (4, "MIT"), (None, "MIT"), (9, "MIT"), (9, "CC-BY-NC-4.0"), (10, "MIT")], key=str
    )
    first = {r.doc_id: r for r in found if r.license == "MIT"}
    assert first[1].first_word == 500 and first[3].first_word == 500 and first[2].containment == 1
    expected = len(plain_shingles(MIT) & plain_shingles(changed)) / len(plain_shingles(MIT))
    assert first[4].containment == pytest.approx(expected) and expected >= 0.8


def test_scan_finds_occurrences_anywhere(spark):
    words = [f"f{n}" for n in range(700)]
    rows = [(n, " ".join([*words[:n], MIT, *words[n:]])) for n in range(0, 700, 7)]
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string"), licenses.templates(spark))
    assert {r.doc_id for r in found.collect()} == {n for n, _ in rows}


def test_scan_finds_short_notices_in_long_texts(spark):
    notices = [(0, "ARR", "All rights reserved."), (1, "PD", "Public domain"), (2, "MIT", "Released under the MIT License."), (3, "none", "-")]
    known = spark.createDataFrame(notices, "template int, license string, text string")
    rows = [
        (1, f"{FILLER}\nAll rights reserved.\n{FILLER}"), (2, "All rights reserved"), (3, f"{FILLER} all rights"),
        (4, "(c) ACME, all RIGHTS reserved"), (5, f"public domain {FILLER} Released under the MIT License. All rights reserved."),
        (6, "all rights are reserved"), (7, None), (8, "domain"), (None, f"{FILLER} public domain"),
    ]
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    expected = [(1, "ARR"), (2, "ARR"), (4, "ARR"), (5, "ARR"), (5, "PD"), (5, "MIT"), (None, "PD")]
    assert sorted(((r.doc_id, r.license) for r in found), key=str) == sorted(expected, key=str)
    assert {r.doc_id: r.first_word for r in found if r.license == "ARR"}[1] == 500


def test_scan_query_finds_every_notice_line(spark):
    from sedimenta.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    lines = {"All rights reserved.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0."}
    lines |= {"Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."}
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    marked = {d.doc_id for d in documents if lines & set((d.text or "").split("\n"))}
    assert marked and marked <= {r.doc_id for r in QUERIES["op2_license_scan"](spark, folder).collect()}


def test_scan_without_rows_or_templates(spark):
    df = spark.createDataFrame([(1, MIT)], "doc_id long, text string")
    assert licenses.scanned(df.limit(0), licenses.templates(spark)).collect() == []
    none = spark.createDataFrame([], "template int, license string, text string")
    assert licenses.scanned(df, none).collect() == []


def test_scan_query(spark):
    from sedimenta.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    # a template of fewer than five words is one shingle of as many
    lengths = {text: min(5, len(plain_words(text))) for _, text in licenses.TEMPLATES}
    known = [(name, lengths[text], plain_shingles(text, lengths[text])) for name, text in licenses.TEMPLATES]
    expected = set()
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        mine = {n: plain_shingles(row.text or "", n) for n in set(lengths.values())}
        expected |= {(row.doc_id, name) for name, n, wanted in known if len(mine[n] & wanted) >= 0.8 * len(wanted)}
    found = QUERIES["op2_license_scan"](spark, folder).collect()
    assert {(r.doc_id, r.license) for r in found} == expected


def test_chain_uses_earlier_categories(spark):
    random = np.random.default_rng(1)
    rows, labels = [], []
    for n in range(600):
        rude, threat = random.random() < 0.3, random.random() < 0.5
        words = [f"w{k}" for k in random.integers(0, 300, 40)] + ["idiot"] * rude + ["beware"] * threat
        rows.append((n, " ".join(words)))
        labels.append((n, int(rude), int(rude and threat)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, rude int, threat int")
    sample = toxicity.sampled(marks, ["rude", "threat"], most=400)
    assert sample.count() == 400
    chain = toxicity.trained(df, sample, ["rude", "threat"])
    assert [len(w) for w in chain.weights] == [toxicity.BUCKETS + 1, toxicity.BUCKETS + 2]
    assert chain.weights[1][-2] > 0  # a threat is rude
    seen = {r.id for r in sample.collect()}
    scores = [r for r in toxicity.scored(df, chain).collect() if r.doc_id not in seen]
    right = [(r.p_rude >= 0.5) == labels[r.doc_id][1] for r in scores]
    assert np.mean(right) >= 0.95
    assert np.mean([(r.p_threat >= 0.5) == labels[r.doc_id][2] for r in scores]) >= 0.85


def test_chain_edges(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 4), (None, "a", 5), (3, "x " * 200_000, 6)], "doc_id long, text string, _p long")
    none = spark.createDataFrame([], "doc_id long, a int")
    chain = toxicity.trained(df, toxicity.sampled(none, ["a"]), ["a"])
    found = toxicity.scored(df, chain)
    assert found.columns == [*df.columns, "p_a"] and {r.p_a for r in found.collect()} == {0.5}
    assert toxicity.scored(df.limit(0), chain).collect() == []
    repeated = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id long, a int")
    assert toxicity.sampled(repeated, ["a"]).collect() == [(1, 1)]


def test_toxicity_held_out(spark):
    """On the larger table: half of the insults are of languages with few texts."""
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    sample = toxicity.sampled(labels, ["toxic"], most=3000)
    chain = toxicity.trained(documents, sample, ["toxic"])
    seen = {r.id for r in sample.collect()}
    rows = toxicity.scored(documents.join(labels, "doc_id"), chain).collect()
    rows = [r for r in rows if r.doc_id not in seen]
    caught = [r.p_toxic >= 0.5 for r in rows if r.toxic == 1]
    wrong = [r.p_toxic >= 0.5 for r in rows if r.toxic == 0]
    assert np.mean(caught) >= 0.9 and np.mean(wrong) <= 0.02
