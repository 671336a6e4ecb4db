"""Language identification: Viterbi against all paths, mixed texts, held-out accuracy."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import language_id, queries
from churnlens.llm.language_id import FEATURES, FLOOR, SCRIPTS, SWITCH, LanguageModel

SYLLABLES = {
    "aa": ["ka", "lu", "mi", "tor", "ne"], "bb": ["sch", "un", "ge", "ber", "ich"],
    "cc": ["ção", "que", "eu", "ment", "ai"], "dd": ["по", "ка", "ло", "ний", "ст"],
    "ee": ["的", "是", "不", "我", "有"]}


def _prose(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(5 * i + k, _prose(lang, 60, i), lang, "s", 7)
            for i in range(30) for k, lang in enumerate(SYLLABLES)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string, n int")


@pytest.fixture(scope="module")
def model(docs):
    return language_id.fit(docs)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    scores = -rng.integers(0, 12, size=(40, 3)).astype(float)
    texts = [rng.integers(0, 40, size=n) for n in (0, 1, 7, 3, 7, 2, 6)]
    for ids, got in zip(texts, language_id.viterbi(scores, texts), strict=True):
        def total(path, ids=ids):
            return sum(scores[w, x] for w, x in zip(ids, path, strict=True)) - SWITCH * sum(
                a != b for a, b in zip(path, path[1:], strict=False))
        assert len(got) == len(ids)
        assert total(tuple(got)) == max(total(p) for p in product(range(3), repeat=len(ids)))


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["Ab", "x", "ÉTÉ", "не", "zz" * 12]
    whole, grams, begin, scripts = language_id.features(words)
    ends = np.append(begin, len(grams))[1:]
    for i, w in enumerate(words):
        one = language_id.features([w])
        assert one[0][0] == whole[i] and (one[3][0] == scripts[i]).all()
        assert one[1].tolist() == grams[begin[i]:ends[i]].tolist() and len(one[1]) == len(w)
    assert SCRIPTS[scripts[3].argmax()] == "Cyrillic"


def test_scripts_narrow_candidates():
    letters = np.zeros((3, len(SCRIPTS)))
    letters[0, SCRIPTS.index("Latin")] = letters[1, SCRIPTS.index("Latin")] = 1000
    letters[1, SCRIPTS.index("Greek")] = 4            # below the share of a candidate
    letters[2, SCRIPTS.index("Cyrillic")] = 1000
    model = LanguageModel.of_counts(["a", "b", "c"], np.zeros((3, FEATURES)), letters)
    latin, cyrillic, greek, none = model.word_scores(["ab", "не", "αβ", "²"])
    assert latin.tolist() == [0, 0, -2 * FLOOR] and cyrillic.tolist() == [-2 * FLOOR] * 2 + [0]
    assert greek.tolist() == [0, 0, 0] and none.tolist() == [0, 0, 0]


def test_mixed_texts(spark, model):
    parts = [("aa", 30), ("dd", 25), ("bb", 40), ("ee", 12)]
    pieces = [_prose(lang, n, "mixed") for lang, n in parts]
    text = " | ".join(pieces)
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    got = language_id.label(df, model).collect()
    assert got[0] == got[1]
    spans = got[0]["spans"]
    assert [s["lang"] for s in spans] == [p[0] for p in parts]
    assert spans[0]["start"] == 0 and spans[-1]["end"] == len(text)
    assert all(a["end"] == b["start"] for a, b in zip(spans, spans[1:], strict=False))
    for s, piece in zip(spans, pieces, strict=True):
        assert text[s["start"]:s["end"]].strip(" |") == piece
    assert got[0]["lang_pred"] == "bb" and 0.2 < got[0]["score"] < 0.6


def test_cases(spark, docs, model):
    rows = [(1, None), (2, ""), (3, "12 -- ²"), (None, _prose("cc", 20, 1)), (5, _prose("ee", 3000, 2)),
            (6, "не")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("lang_pred", F.lit(1))
    got = {r["doc_id"]: (r["lang_pred"], r["score"], len(r["spans"]))
           for r in language_id.label(df, model).collect()}
    assert got == {1: ("und", 0.0, 0), 2: ("und", 0.0, 0), 3: ("und", 0.0, 0), None: ("cc", 1.0, 1),
                   5: ("ee", 1.0, 1), 6: ("dd", 1.0, 1)}
    nothing = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.label(df, nothing).collect()} == {"und"}
    assert language_id.label(df.limit(0), model).count() == 0


def test_training_rows_are_bounded(spark):
    rows = [(i, "x", "aa") for i in range(3000)] + [(7, f"y{i}", "bb") for i in range(500)]
    df = spark.createDataFrame([*rows, (None, "z", "cc"), (9, "z", None)],
                               "doc_id long, text string, lang string")
    got = language_id.training_texts(df, 1000).groupBy("lang").count().collect()
    n = {r["lang"]: r["count"] for r in got}
    assert set(n) <= {"aa", "bb"} and 850 < n["aa"] < 1150 and n.get("bb", 0) <= 1
    assert language_id.training_texts(df, 10_000).count() == 3001


def test_query_on_held_out_documents(spark, docs, tmp_path):
    # labels of held-out documents are never read: they are wrong here
    out = F.crc32(docs.doc_id.cast("string")) % 4 == 2
    docs.withColumn("lang", F.when(out, "zz").otherwise(docs.lang)).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.op13_language_id(spark, str(tmp_path)).join(docs, "doc_id").collect()
    assert 10 < sum(r["held_out"] for r in got) < 80
    assert all(r["lang_pred"] == r["lang"] for r in got)
