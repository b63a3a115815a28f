"""Language labels: held-out accuracy, mixed texts, scripts, edge cases; Viterbi against all paths."""

import itertools

import numpy as np
import pytest

from tablesync.llm import language as lg

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(docs):
    return lg.train(docs)


def labels(spark, model, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    return [r for r in sorted(lg.label(df, model).collect(), key=lambda r: r["i"])]


def test_held_out_accuracy(spark, docs):
    got = {r["doc_id"]: r for r in lg.op7(spark, SF).collect()}
    assert len(got) == docs.count()
    held = [(r["lang"], got[r["doc_id"]]) for r in docs.select("doc_id", "lang").collect() if got[r["doc_id"]]["held_out"]]
    assert held and sum(lang == r["lang_pred"] for lang, r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_a_mixed_text_has_a_span_for_each_language(spark, docs, model):
    texts = {lang: " ".join(docs.where(f"lang = '{lang}' and n_chars > 600").first()["text"].split()[:60])
             for lang in ("en", "de")}
    row, = labels(spark, model, texts["en"] + " " + texts["de"])
    spans = [s for s in row["spans"] if s["n_words"] > 20]
    assert [s["lang"] for s in spans] == ["en", "de"]
    assert row["spans"][0]["first_word"] == 0
    assert sum(s["n_words"] for s in row["spans"]) == len(lg.LETTERS.findall(texts["en"] + " " + texts["de"]))


def test_edge_cases(spark, model):
    rows = labels(spark, model, None, "", "12 %% --", "ΩΩΩ", "x", "the and of " * 200_000)
    assert [r["lang_pred"] for r in rows[:3]] == ["und"] * 3
    assert [r["score"] for r in rows[:3]] == [0.0] * 3 and rows[0]["spans"] == []
    assert rows[3]["lang_pred"] in model.languages and rows[4]["lang_pred"] in model.languages
    assert rows[5]["lang_pred"] == "en" and rows[5]["score"] == 1.0


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([(1, "text", None), (None, "text", "en")], "doc_id long, text string, lang string")
    nothing = lg.train(empty)
    assert nothing.languages == []
    assert [r["lang_pred"] for r in labels(spark, nothing, "some text")] == ["und"]


def test_scripts_narrow_the_languages(spark):
    rows = [(i, "abc def ghi " * 20, "la") for i in range(20)] + [(i, "абв где жзи " * 20, "cy") for i in range(20, 40)]
    known = lg.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = labels(spark, known, "абв xyz", "где " * 10 + "qqq " * 5, "zzz")
    assert [r["lang_pred"] for r in got][1:] == ["cy", "la"]
    assert {s["lang"] for s in got[1]["spans"]} == {"cy", "la"}


def test_columns_pass_untouched(spark, model):
    df = spark.createDataFrame([(None, "the of and", "a", 2**60 + 1)], "doc_id long, text string, score2 string, n long")
    row, = lg.label(df, model).collect()
    assert (row["doc_id"], row["score2"], row["n"]) == (None, "a", 2**60 + 1)


def test_the_stage_drops_texts_without_letters_only(spark, docs):
    extra = spark.createDataFrame([(10**9, None, None, None, None), (10**9 + 1, "123", "en", "s", 3)], docs.schema)
    kept = lg.stage(spark, docs.unionByName(extra), SF)
    assert kept.schema == docs.schema
    assert kept.where("doc_id >= 1000000000").count() == 0 and kept.count() == docs.count()


def test_the_stage_drops_foreign_and_junk_texts_and_keeps_mixed_ones(spark, docs, model):
    passages = [" ".join(docs.where(f"lang = '{lang}' and n_chars > 600").first()["text"].split()[:60]) for lang in ("en", "de", "fr")]
    greek, junk = "η γρήγορη αλεπού πηδάει πάνω " * 10, "xqzj kkqwv zzxq wvvk qjxz " * 10
    texts = [greek, junk, greek + passages[0][:60], " ".join(passages), passages[1] + " αλεπού", "และ " * 20]
    extra = spark.createDataFrame([(10**9 + i, t, None, None, None) for i, t in enumerate(texts)], docs.schema)
    kept = lg.stage(spark, docs.unionByName(extra), SF).where("doc_id >= 1000000000").collect()
    assert sorted(r["doc_id"] - 10**9 for r in kept) == [3, 4]
    rows = labels(spark, model, greek, passages[1] + " αλεπού")
    assert rows[0]["lang_pred"] in model.languages and rows[0]["score"] == 0.0
    assert rows[1]["lang_pred"] == "de" and 0.9 < rows[1]["score"] < 1.0


def test_the_stage_keeps_letters_with_nothing_to_learn_from(spark):
    unlabelled = spark.createDataFrame([(1, "some text", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in lg.stage(spark, unlabelled, SF).collect()] == [1]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    lengths = np.array([4, 1, 6, 3])
    scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
    got, at = lg.viterbi(scores, lengths, 0.7), 0
    for n in lengths:
        part = scores[at:at + n].astype(float)

        def value(path):
            return sum(part[i, p] for i, p in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert value(got[at:at + n].tolist()) == pytest.approx(value(best))
        at += n


def test_numbers_are_no_letters_and_marks_stay_in_words(spark, model):
    assert lg.LETTERS.findall("½ ² ① Ⅳ x² हिन्दी e\u0301a \u0301") == ["x", "हिन्दी", "e\u0301a"]
    low = "".join(map(chr, range(0x300)))
    assert lg.words_in(low) == lg.LETTERS.findall(low)
    assert all(lg.words_in(t) == lg.LETTERS.findall(t) for t in ("naïve ½a", "e\u0301a ß", "x1y_z", "हिन्दी a"))
    rows = labels(spark, model, "½ ² ①", "\u0301 \u0301")
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)] * 2
