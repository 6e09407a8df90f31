"""The pipeline's stages on empty tables, extra columns, NULLs and repeated rows."""

import pytest

import corpus_pipeline
from tests.llm.util import awkward_docs, clashing, frame


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_a_stage_keeps_the_columns_and_takes_an_empty_table(spark, name, stage):
    empty = clashing(frame(spark, []))
    out = stage(spark, empty, "")
    assert out.columns == empty.columns and out.count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_a_stage_takes_awkward_rows_with_clashing_columns(spark, name, stage):
    docs = clashing(frame(spark))
    out = stage(spark, docs, "")
    rows = out.collect()
    assert out.columns == docs.columns and 0 < len(rows) <= 3 * len(awkward_docs())
    assert {r["doc_id"] for r in rows} <= {r[0] for r in awkward_docs()} and {r["cls"] for r in rows} == {"x"}
    if name == "language":
        assert all(r["text"] and r["lang"] for r in rows)
    if name == "secrets":
        assert len(rows) == len(awkward_docs())
