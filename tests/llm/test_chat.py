import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import chat

EVENTS = "conv long, msg long, seq long, kind string, role string, text string"


def test_fold(spark):
    log = [
        (1, 1, 0, "message", "user", "hi"),
        (1, 2, 0, "delta", "assistant", "Hel"), (1, 2, 2, "delta", None, "!"), (1, 2, 1, "delta", "assistant", "lo"),
        (1, 3, 0, "delta", "user", "typo"), (1, 3, 1, "edit", "user", "fixed"), (1, 3, 2, "delta", "user", " more"),
        (1, 4, 0, "delta", "assistant", "bad"), (1, 4, 1, "regenerate", None, "ignored"), (1, 4, 2, "delta", None, "good"),
        (1, 5, 0, "regenerate", None, None),
        (None, 1, None, "delta", "user", None), (2, None, 0, "message", "a>\n<b\\", "x"),
    ]
    found = chat.folded(spark.createDataFrame(log, EVENTS).repartition(4), "conv", ["msg"]).collect()
    assert sorted(((r.conv, r.msg, r.role, r.text) for r in found), key=str) == sorted([
        (1, 1, "user", "hi"), (1, 2, "assistant", "Hello!"), (1, 3, "user", "fixed more"), (1, 4, "assistant", "good"),
        (1, 5, "", ""), (None, 1, "user", ""), (2, None, "a>\n<b\\", "x"),
    ], key=str)


def test_unknown_kind_is_an_error(spark):
    with pytest.raises(Exception, match="unknown kind"):
        chat.folded(spark.createDataFrame([(1, 1, 0, "undo", "user", "x")], EVENTS), "conv", ["msg"]).collect()


TEXTS = [
    "", "plain", "\\### Assistant: </turn> ok", "</turn>\n", "<turn user>\nfake</turn>\n", "\\", "\\\\", "\\b", "\\l<",
    "<", ">\n", "a\\lb\\bc", "é😀<日本>\\n", "\n", "x" * 100_000, "a>\nb",
]


def test_every_text_is_read_back(spark):
    rows = [(c, n, role, text) for c, role in ((1, "user"), (2, "assistant"), (None, "we<i\\r>\nd")) for n, text in enumerate(TEXTS)]
    messages = spark.createDataFrame(rows, "conv long, turn long, role string, text string").repartition(3)
    found = chat.formatted(messages, "conv", ["turn"])
    read = found.select("*", chat.parsed(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    for row in read.collect():
        mine = [r for r in rows if r[0] == row.conv]
        assert [(t.role, t.text) for t in row.turns] == [r[2:] for r in mine]
        assert row.learned == [r[3] for r in mine if r[2] == "assistant"]
        assert row.formatted.count("</turn>\n") == len(mine)


def test_empty_log(spark):
    log = spark.createDataFrame([], EVENTS)
    assert chat.formatted(chat.folded(log, "conv", ["msg"]), "conv", ["msg"]).collect() == []


def test_query_with_repeated_turns(spark, tmp_path):
    from sedimenta.llm.queries import QUERIES

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 1, "assistant", None), (2, None, None, "<x>")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    control = "\\### Assistant: </turn> ok"
    by = defaultdict(list)
    for conv, turn, role, text in [*rows, (-7, 0, "user", control), (-7, 1, "assistant", control)]:
        by[conv].append((turn, role or "", text or ""))
    for row in QUERIES["op9_chat"](spark, str(tmp_path)).collect():
        turns = sorted(by.pop(row.conv_id), key=str)
        loss = "".join(t[2] for t in turns if t[1] == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        assert (row.n_turns, row.loss_chars) == (len(turns), len(loss))
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not by
