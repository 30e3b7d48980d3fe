"""Clashing column names are renamed inside and refused where they are results; empty and null tables pass the pipeline."""

import pytest

import corpus_pipeline
from tallyworks.llm import decontamination, language, toxicity, url_lm

RULES = [url_lm.Rule("block", "net", "/")]


def test_urls_next_to_inner_names(spark):
    rows = [(1, "http://a.net/x", "p", "q", 5), (2, "http://b.org/y", "p", "q", 6), (3, None, None, None, None), (1, "http://a.net/x", "p", "q", 5)]
    pages = spark.createDataFrame(rows, "page_id int, url string, _url string, _found string, rejected int")
    found = url_lm.judge(pages, RULES)
    assert found.columns == [*pages.columns, *url_lm.RESULT]
    assert sorted((r.page_id, r.host, r.verdict, r._url) for r in found.collect()) == [
        (1, "a.net", "block", "p"), (1, "a.net", "block", "p"), (2, "b.org", "allow", "p"), (3, "", "allow", None),
    ]


def test_taken_results_are_refused(spark):
    table = spark.createDataFrame([(1, "http://a.b", "t", 0.5)], "page_id int, url string, text string, Score double")
    with pytest.raises(ValueError):
        url_lm.judge(table, RULES)
    with pytest.raises(ValueError):
        toxicity.score(table, toxicity.Model(__import__("numpy").zeros(1 << toxicity.BITS), -7.0))
    with pytest.raises(ValueError):
        decontamination.contamination(table, table.select("page_id", "text"), item_col="page_id", found_col="SCORE")
    with pytest.raises(ValueError):
        language.predict(table, language.Model.__new__(language.Model))


def test_blocks_of_windows_are_released(spark, monkeypatch):
    words = [f"w{k}" for k in range(400)]
    items = spark.createDataFrame([(k, " ".join(words[k : k + 13])) for k in range(0, 380, 7)], "item_id int, text string")
    docs = spark.createDataFrame([(k, " ".join(words[k * 50 : k * 50 + 90])) for k in range(7)] + [(9, None)], "doc_id int, text string")
    whole = decontamination.contamination(docs, items).collect()
    monkeypatch.setattr(decontamination, "TOGETHER", 2)
    parts = decontamination.contamination(docs, items, block=8).collect()
    assert sorted(map(str, parts)) == sorted(map(str, whole)) and sum(r.contamination.n_hit for r in whole) > 100


DOCS = "doc_id long, text string, lang string, source string, n_chars long, _vertex int, _score string, vertex long, text_a string"


@pytest.mark.parametrize("rows", [[], [(1, None), (2, None), (None, None), (1, None)], [(1, "only one text here"), (1, "only one text here"), (2, "")]])
def test_pipeline_on_odd_tables(spark, tmp_path, rows):
    folder = str(tmp_path / "sf")
    spark.createDataFrame([(*r, "en", None, 1, 2, "s", 3, "t") for r in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, folder).collect()
    texts = {r[1] or "" for r in rows}
    # equal texts and the empty one are one document each
    assert len(packed) == len(texts)
