"""The pipeline over an empty table, and over nulls, empty and long texts, repeated rows and clashing names."""

import test_edges
from pyspark.sql import functions as F

import corpus_pipeline


def test_an_empty_table_passes_through(spark, tmp_path):
    spark.createDataFrame([], test_edges.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and {"doc_id", "ids_crc32", "sequence_id"} <= set(out.columns)


LINES = [" ".join(f"word{i}of{k}" for i in range(8)) for k in range(6)]
ROWS = [
    (1, "\n".join(LINES), "en", "a", 1),
    (1, "\n".join(LINES), "en", "a", 1),
    (2, "\n".join(LINES[:4]) + " changed\n" + "\n".join(LINES[4:]), None, None, None),
    (3, None, "en", "b", 0),
    (4, "", "xx", "b", 0),
    (5, " \n\t ", "de", None, 3),
    (None, "a text without an id that has words enough to be kept here", "en", "a", 5),
    (None, None, None, None, None),
    (6, test_edges.LONG, "en", "a", len(test_edges.LONG)),
    (7, "too short", "fr", "c", 9),
    (8, "same words again and again " * 20, "en", "c", 9),
]


def test_edges_pass_through_all_stages(spark, tmp_path):
    """Rejected are texts under ten words and those that repeat themselves; of equal rows and near copies one stays, one without an id stays; columns of documents stay as they are."""
    docs = spark.createDataFrame(ROWS, test_edges.SCHEMA).withColumns({c: F.lit(i) for i, c in enumerate(test_edges.CLASH)})
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *test_edges.CLASH]
        seen[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert seen["quality_rules"] == seen["line_dedup"] == [1, 1, 2, 6, None]
    assert seen["near_dedup"] == [1, 2, 6, None] and set(seen["mixing"]) <= {1, 2, 6, None}
    docs.write.parquet(f"{tmp_path}/last")
    rows = corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(f"{tmp_path}/last"), str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == set(seen["mixing"])
