"""The whole pipeline on odd tables."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tenura import session


def written(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_odd_documents_pass_through_all_stages(spark, edge, tmp_path):
    """Nulls, empty and long texts, repeated rows, and extra columns with the names that stages use."""
    odd = edge.withColumns({c: F.lit("x") for c in ("score", "predicted", "keep_id", "kept", "fp", "spans", "items", "n_words", "piece", "__key")})
    sf = written(spark, tmp_path, odd, [(1, 1, 0), (2, 1, None), (None, 0, 1), (6, 1, 0), (99, 0, 1)], [(1, "same line other line same line"), (None, None)])
    before = len(session._STAGED)
    out = corpus_pipeline.run(spark, sf)
    rows = out.collect()
    # The result's own copy is all that is left.
    assert len(session._STAGED) == before + 1 and os.path.isdir(session._STAGED[-1].removeprefix("file:"))
    texts = {(r.doc_id, r.text or "") for r in edge.collect()}
    assert {r.doc_id for r in rows} <= {i for i, _ in texts}
    # One of the equal texts, and one of the long near copies; the long one in whole.
    assert not {1, 14} <= {r.doc_id for r in rows} and len({r.doc_id for r in rows} & {6, 7}) == 1
    long = [r for r in rows if r.doc_id in (6, 7)]
    assert sum(r.length for r in long) == max(r.start + r.length for r in long) > 2048
    for s in {r.sequence_id for r in rows}:
        held = sorted((r.offset, r.length) for r in rows if r.sequence_id == s)
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and sum(held[-1]) <= 2048
    out.sparkSession.catalog.clearCache()
    session.drop_staged(out)
    assert len(session._STAGED) == before


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_no_documents(spark, empty, tmp_path, labels):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, empty, labels, [])).count() == 0
