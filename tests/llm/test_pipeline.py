"""Every stage of the pipeline on a small table, and the whole of it."""

import corpus_pipeline
from test_operators import DOCS, prose


def _write(spark, folder, rows):
    spark.createDataFrame(rows, DOCS).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, prose(99, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def row(doc, text, lang="en", source="a"):
    return (doc, text, lang, source, len(text or ""), "", "", "")


def test_stages(spark, tmp_path):
    clean = [row(i, prose(i, 80)) for i in range(20, 40)]
    rows = [*clean, row(1, prose(50, 90)), row(2, prose(50, 90)), row(1, prose(50, 90)), row(3, prose(51, 20) + " " + prose(99, 30)), row(4, "123 456"), row(5, None), row(6, prose(52, 70) + " password = hunter22 x", None), row(None, prose(50, 90))]
    _write(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = lambda df: sorted(str(r["doc_id"]) for r in df.collect())
    known = corpus_pipeline.known_language(spark, docs, str(tmp_path))
    assert ids(known) == sorted(["1", "1", "2", "3", "6", "None", *map(str, range(20, 40))])
    once = corpus_pipeline.near_duplicates(spark, known, str(tmp_path))
    assert ids(once) == sorted(["1", "3", "6", *map(str, range(20, 40))])
    clear = corpus_pipeline.decontaminated(spark, once, str(tmp_path))
    assert ids(clear) == sorted(["1", "6", *map(str, range(20, 40))])
    safe = corpus_pipeline.without_secrets(spark, clear, str(tmp_path))
    masked = {r["doc_id"]: r["text"] for r in safe.collect()}
    assert masked[6] == prose(52, 70) + " [SECRET] x" and masked[1] == prose(50, 90)
    assert safe.columns == docs.columns
    mix = corpus_pipeline.mixed(spark, safe, str(tmp_path)).collect()
    assert {r["doc_id"] for r in mix} == set(masked) and all(r["repeats"] == 1 for r in mix)


def test_empty(spark, tmp_path):
    _write(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
