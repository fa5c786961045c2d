import zlib

import numpy as np
import pytest

from sedimenta.llm import language_id as li

ENGLISH = "the cat sat with the dog and they were watching that bird by the window"
GERMAN = "der hund liegt nicht auf dem sofa und die katze schläft über dem schrank"
FRENCH = "le chat est dans la maison avec les enfants qui jouent près de la fenêtre"
GREEK = "η γάτα κοιμάται στον καναπέ και ο σκύλος είναι έξω"
RUSSIAN = "кошка спит на диване а собака гуляет во дворе"
ROWS = [(n, t, lang) for n, (t, lang) in enumerate(
    [(ENGLISH, "en"), (GERMAN, "de"), (FRENCH, "fr"), (GREEK, "el"), (RUSSIAN, "ru"), (None, "en"), ("", "de"), ("x", None)] * 3
)]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def model(spark):
    return li.trained(spark.createDataFrame(ROWS, SCHEMA).repartition(3))


def plain_viterbi(scores, penalty):
    best, back = scores[0].copy(), []
    for step in range(1, len(scores)):
        jump = int(best.argmax())
        stay = best >= best[jump] - penalty[step]
        back.append(np.where(stay, np.arange(len(best)), jump))
        best = np.where(stay, best, best[jump] - penalty[step]) + scores[step]
    path = [int(best.argmax())]
    for row in reversed(back):
        path.append(int(row[path[-1]]))
    return path[::-1], best.max()


@pytest.mark.parametrize("n,labels,block", [(1, 1, 64), (1, 3, 64), (5, 2, 2), (63, 4, 8), (64, 4, 64), (500, 5, 64)])
def test_blocks_of_viterbi_find_the_best_path(n, labels, block):
    random = np.random.default_rng(n)
    scores, penalty = random.normal(size=(n, labels)), random.choice([0.0, 0.7, 3.0], n)
    path = li.viterbi(scores, penalty, block)
    _, best = plain_viterbi(scores, penalty)
    value = scores[np.arange(n), path].sum() - penalty[1:][path[1:] != path[:-1]].sum()
    assert value == pytest.approx(best)


def test_spans_of_a_mixed_text(spark, model):
    text = f"{ENGLISH} {GERMAN}. {GREEK}"
    row = li.labelled(spark.createDataFrame([(text,)], "text string"), model).first()
    assert [s.lang for s in row.spans] == ["en", "de", "el"]
    assert [text[s.start : s.stop] for s in row.spans] == [ENGLISH, GERMAN, GREEK]
    assert sum(s.letters for s in row.spans) == sum(c.isalpha() for c in text)


def test_predictions_and_edges(spark, model):
    texts = [ENGLISH, GERMAN.upper(), FRENCH, GREEK, RUSSIAN, None, "", "123 !!", "x" * 100_000, f"{ENGLISH} " * 3000]
    df = spark.createDataFrame([(n, t, n) for n, t in enumerate(texts)], "doc_id long, text string, _found long")
    found = sorted(li.predicted(df, model).collect())
    assert [r.lang_pred for r in found[:8]] == ["en", "de", "fr", "el", "ru", "und", "und", "und"]
    assert found[9].lang_pred == "en" and all(0 <= r.score <= 1 for r in found)
    assert [r.score for r in found[5:8]] == [0, 0, 0] and found[0]["_found"] == 0


def test_candidates_follow_the_script(model):
    words = li._Words(model)
    scores = dict(zip(["η", "кошка", "dog"], words.look_up(["η", "кошка", "dog"])))
    at = model.languages.index
    assert scores["η"].argmax() == at("el") and scores["кошка"].argmax() == at("ru")
    assert scores["dog"][at("el")] == -li.FLOOR and scores["dog"][at("ru")] == -li.FLOOR


def test_long_runs_are_read_whole(spark):
    english, german = (x.replace(" ", "") for x in (ENGLISH, GERMAN))
    han, kana = "的一是不了人我在有他这中大来上国", "のにはをたがでてとしれさあるいもす"
    random = np.random.default_rng(3)

    def mixed(letters, n):
        return "".join(random.choice(list(letters), n))

    rows = [(english, "en"), (german, "de"), (mixed(han, 3000), "zh"), (mixed(kana, 3000), "ja")]
    # letters that only stand after the first 40 of a run tell two languages of one script apart
    rows += [(mixed("абвгд", 40) + mixed("ёжзик", 400), "ru"), (mixed("абвгд", 40) + mixed("їєґіў", 400), "uk")]
    model = li.trained(spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], SCHEMA))
    cyrillic = mixed("ёжзик", 120) + mixed("їєґіў", 400)
    texts = {
        english[:40] * 3 + german[:40] * 4: [(0, 120, "en"), (120, 280, "de")],  # no single word decides
        cyrillic: [(0, 120, "ru"), (120, 520, "uk")],
        "A" + mixed(han, 1000): [(1, 1001, "zh")],
        mixed(han, 100) + mixed(kana, 1000): [(0, 100, "zh"), (100, 1100, "ja")],
        "x, " + mixed(kana, 3) + " é " + mixed(han, 50) + "é": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in li.predicted(li.labelled(df, model), model).collect():
        spans = [(s.start, s.stop, s.lang) for s in row.spans]
        if texts[row.text]:
            assert spans[-len(texts[row.text]) :] == texts[row.text]
            assert row.lang_pred == spans[-1][2]
        assert sum(s.letters for s in row.spans) == sum(c.isalpha() for c in row.text)


def test_cuts_cover_each_run():
    cutter = li._Cutter()
    for text in ("a" * 81, "", "Aé" * 60 + "的" * 41 + "のß of λόγος 7x", "ab—cd “日本語テキスト”", "x" * 40 + "é" * 41):
        places, words = cutter.places(text), cutter.words(text)
        assert [text[a:b] for a, b in places] == words and "".join(words) == "".join(c for c in text if c.isalpha())
        assert all(len(w) <= li.WORD_LETTERS and len(set(li._scripts(list(w)))) == 1 for w in words)
    assert list(map(len, cutter.words("A" + "的" * 90))) == [1, 40, 40, 10]


def test_no_labels_and_empty_tables(spark):
    none = li.trained(spark.createDataFrame([(1, "a b", None)], SCHEMA))
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert none.languages == []
    assert [(r.lang_pred, r.score) for r in li.predicted(df, none).collect()] == [("und", 0.0)] * 2
    assert li.predicted(df.limit(0), none).collect() == [] and li.labelled(df.limit(0), none).collect() == []


def test_partitions_do_not_matter(spark, model):
    other = li.trained(spark.createDataFrame(ROWS, SCHEMA).repartition(5))
    assert other.languages == model.languages
    np.testing.assert_allclose(other.scores, model.scores, rtol=1e-5)


def test_held_out_accuracy(spark):
    from sedimenta.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language_id"](spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
