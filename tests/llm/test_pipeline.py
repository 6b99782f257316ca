"""The pipeline's stages, their order, and what they keep."""

from __future__ import annotations

import corpus_pipeline as pipeline
import pytest
from turnmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with the tables that stages read, for the awkward documents."""
    folder = tmp_path_factory.mktemp("tables")
    labels = [(k, int(k % 4 == 0), 0) for k in range(7, 30)] + [(8, None, 1), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    item = "one two three"
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_order_and_names():
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "language_id", "near_dedup", "decontamination", "byte_bpe",
    ]
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))


def test_awkward_rows_pass_all_stages(spark, awkward, nothing, tables):
    docs, kept = awkward, {}
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, tables)
        assert after.columns == docs.columns
        kept[name] = after.collect()
        assert {tuple(r) for r in kept[name]} <= {tuple(r) for r in docs.collect()}
        assert stage(spark, nothing, tables).collect() == []
        docs = after
    texts = [r["text"] for r in kept["language_id"]]
    assert None not in texts and "" not in texts and "1 2 3 ... !!!" not in texts and "é" in texts
    ids = [r["doc_id"] for r in kept["near_dedup"] if r["doc_id"] is not None]
    assert len(ids) == len(set(ids))
    assert 31 in ids and not {32, 33, 34, 35} & set(ids)  # base, copies and near copies
    assert "one two three" not in [r["text"] for r in kept["decontamination"]]
    made = pipeline.byte_bpe(spark, docs, tables).collect()
    assert len(made) == len(kept["decontamination"])
    assert all(len(r["ids"]) == r["n_tokens"] for r in made)


def test_run_on_the_given_tables(spark, small):
    made = pipeline.run(spark, small)
    documents = spark.read.parquet(f"{small}/documents.parquet").count()
    assert documents * 0.5 < made.count() < documents
