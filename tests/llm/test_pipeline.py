"""The pipeline's stages on awkward documents: nulls, empty and very long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from parcelflow.llm.common import staged

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, n_removed int, score double"


def documents() -> list[tuple]:
    rnd = random.Random(3)

    def own(n: int) -> str:
        return "\n".join(" ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(10**6)}" for _ in range(8)) for _ in range(n))

    passage = own(6)
    texts = [None, "", "", " \n ", own(4), own(4), f"{own(3)}\n{passage}\n{own(3)}", f"{own(3)}\n{passage}\n{own(3)}", own(4000)]
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None, "x", 7, None) for i, t in enumerate(texts)]
    return rows + [rows[4], (4, own(3), None, None, None, None, None, None), (None, own(3), "en", "s", 1, "y", 1, 1.0),
                   (None, own(3), "en", "s", 1, "y", 1, 1.0), (50, texts[5], "en", "s", 1, "y", 1, 1.0)]


def stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        out.append(docs)
    return [*out, corpus_pipeline.STAGES[-1][1](spark, docs, SF)]


def test_stages_on_awkward_documents(spark):
    listed = documents()
    frame = spark.createDataFrame(listed, SCHEMA)
    clean, cut, single, packed = stages(spark, frame)
    for df in (clean, cut, single):
        assert df.columns == frame.columns
    assert clean.count() == len(listed)  # nothing here is toxic
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (0, None) in texts and (6, listed[6][1]) in texts
    second = next(t for i, t in texts if i == 7)
    assert not set(listed[6][1].split("\n")) & set(second.split("\n"))
    kept = single.collect()
    # Null, empty and blank texts are one group, the copies of 4 and 5 (whose lines went) another way of being empty.
    assert sum(not (r.text or "").strip() for r in kept) == 1
    assert sum(r.doc_id is None for r in kept) == 2 and sum(r.doc_id == 4 for r in kept) == 2
    tokens = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in tokens} == {r.doc_id for r in kept}


def test_stages_on_an_empty_table(spark):
    assert [df.count() for df in stages(spark, spark.createDataFrame([], SCHEMA))] == [0, 0, 0, 0]


@pytest.mark.parametrize("column", ["text", "doc_id", "lang", "source"])
def test_stages_with_a_column_of_nulls(spark, column):
    docs = spark.createDataFrame(documents()[4:7], SCHEMA)
    kind = docs.schema[column].dataType.simpleString()
    docs = docs.selectExpr(*[f"cast(NULL AS {kind}) AS {c}" if c == column else c for c in docs.columns])
    assert stages(spark, docs)[-1].count() >= 1
