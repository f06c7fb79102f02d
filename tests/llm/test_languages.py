import corpus_pipeline
import pytest

from tesserae.llm import language_id

DOCS = "doc_id long, text string, lang string, n_chars long"


def stage(spark, rows):
    return sorted(r.doc_id for r in corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, DOCS), "").collect())


def test_documents_with_letters_stay_where_no_language_can_be_learned(spark):
    rows = [(1, "some plain words", None, 16), (2, "кое-какие слова", None, 15), (3, "12 34", None, 5), (4, None, None, None), (5, "", None, 0)]
    assert stage(spark, rows) == [1, 2]


def test_texts_that_no_learned_language_fits_go(spark):
    rows = [(i, "some plain english words and more of them", "en", 41) for i in range(30)]
    rows += [(100, "漢字だけの文", None, 6), (101, "漢字 with english words", None, 21), (102, "12 34", None, 5)]
    assert stage(spark, rows) == [*range(30), 101]


def test_every_language_is_learned(spark):
    rows = [(100 * k + i, f"{chr(97 + k % 26)}{chr(97 + k // 26)}{'xyz'[k % 3]} " * 5, f"l{k:02d}") for k in range(60) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(df)
    assert model.languages == [f"l{k:02d}" for k in range(60)]
    assert all(r.lang_pred == r.lang for r in language_id.identify(df, model).collect())
    with pytest.raises(ValueError, match="more than 59 languages"):
        language_id.learn(df, max_languages=59)


def test_labels_go_on(spark):
    rows = [(i, "some plain english words and more of them", "en", 41) for i in range(30)] + [(100 + i, "einige deutsche wörter und noch mehr davon", "de", 42) for i in range(30)]
    wrong = [(200, "more plain english words", "de", 24), (201, "noch mehr deutsche wörter", None, 25)]
    out = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows + wrong, DOCS), "").collect()
    assert {r.doc_id: r.lang for r in out if r.doc_id >= 200} == {200: "en", 201: "de"} and len(out) == 62
