import re
from collections import Counter

import pytest

from sedimenta.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the quick brown fox jumps over a lazy dog near the old mill and then it runs back to the house. "
TEXTS = [
    None, "", " \n \t", "one", "one two", "a b c", "a b c a b c", "x x x x x", "x x x y x x x", "line\nline\n\n \nline",
    PROSE * 3, PROSE * 50, "a\x0bb\xa0c # $ <tag> | é😀", "\n".join(f"- item {n} of the list" for n in range(40)),
    " ".join(f"w{n % 97} v{n % 89}" for n in range(9000)), "of the " + " ".join(f"word{n}" for n in range(80)),
]


def plain(text):
    text = text or ""
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in found),
    }


def test_counts(spark):
    df = spark.createDataFrame([(n, t, "k") for n, t in enumerate(TEXTS)], "doc_id long, text string, _words string")
    found = quality.measured(df)
    assert found.columns == [*df.columns, *quality.COUNTS]
    for row in found.collect():
        expected = plain(TEXTS[row.doc_id])
        assert {k: row[k] for k in expected} == expected, TEXTS[row.doc_id]


def test_rules(spark):
    texts = ["of the " + " ".join(f"word{n}" for n in range(80)), "# " * 60 + "of the", "too short", None, PROSE * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    failed = {r.doc_id: r.failed for r in quality.judged(quality.measured(df)).collect()}
    assert failed[0] == [] and "symbols_per_word" in failed[1] and "n_words" in failed[2] and "n_words" in failed[3]
    assert failed[4] == ["repeated_words"]
    only = quality.judged(quality.measured(df), [quality.Rule("few", "n_words", None, None, 10)])
    assert {r.doc_id: r.failed for r in only.collect()} == {0: ["few"], 1: ["few"], 2: [], 3: [], 4: ["few"]}


def test_clashes_and_empty(spark):
    df = spark.createDataFrame([], "text string, n_words long")
    with pytest.raises(ValueError):
        quality.measured(df)
    assert quality.judged(quality.measured(df.drop("n_words"))).collect() == []


def test_no_python_in_the_plan(spark):
    plan = quality.judged(quality.measured(spark.createDataFrame([("a",)], "text string")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString().replace("ExistingRDD", "")


def test_clean_documents_are_kept(spark):
    from sedimenta.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    poor = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean) and sum(not r.kept for r in poor) >= 0.9 * len(poor)
