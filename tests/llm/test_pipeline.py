from pathlib import Path

import pytest
import corpus_pipeline
from odd_rows import ODD


def test_stages_run_on_odd_rows_and_keep_the_columns(spark, documents, prose, tmp_path):
    passage, item = prose(1, 60), prose(2, 15)
    pairs = [(k, prose(10 + k, 80)) for k in range(20)]
    pairs += [(30, prose(3, 20) + "\n" + passage), (31, prose(4, 20) + "\n" + passage), (32, prose(10, 80)), (33, prose(5, 9) + " " + item)]
    docs = documents(*pairs, *ODD, clash=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(k, 0) for k in range(20)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(20)) | {30, 31} <= rows.keys() and not rows.keys() & {32, 33}
    assert passage in rows[30].text and passage not in rows[31].text
    assert rows[31].n_chars == len(rows[31].text) and all(r.lossless for r in rows.values())


TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
}


@pytest.mark.parametrize("empty", list(TABLES))
def test_an_empty_table_stops_no_stage(spark, tmp_path, prose, empty):
    """Without documents there are no rows; without labels none is toxic, without a benchmark none contaminated."""
    rows = {
        "documents": [(k, prose(k, 40), "en", "a", 9) for k in range(12)],
        "labels": [(k, 1, 0) for k in range(12)],
        "benchmark": [(1, prose(5, 15))],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame([] if name == empty else rows[name], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == {"documents": set(), "labels": set(range(12)) - {5}, "benchmark": set(range(12))}[empty]


def test_run_leaves_only_its_last_stage_behind(spark, documents, prose, tmp_path, monkeypatch):
    documents(*[(k, prose(k, 30)) for k in range(5)]).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.createDataFrame([], TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    folders = []
    real = corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, label: folders.append(real(df, label)) or folders[-1])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 5
    left = [path for _, path in folders if Path(path.removeprefix("file:")).exists()]
    assert left == [folders[-1][1]] and len(folders) == 5


def test_a_very_long_text_goes_through_all_stages(spark, tmp_path, prose):
    text = " ".join(prose(k, 400) for k in range(250)) + "\n" + prose(7, 30)
    rows = [(1, text, "en", "a", len(text)), (2, prose(999, 30), "en", "a", 9)]
    spark.createDataFrame(rows, TABLES["documents"]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, prose(5000, 12))], TABLES["benchmark"]).write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], TABLES["labels"]).write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got[1].text == text and got[1].lossless and got.keys() == {1, 2}
