"""Queries against their SQL, and the pipeline stage by stage."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from prospectra.llm import decontaminate, simhash  # noqa: E402
from prospectra.llm.queries import ORACLES, QUERIES  # noqa: E402
from prospectra.llm.quality import fit, score  # noqa: E402
from prospectra.sources import scratch  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first, rules, dedup, clean, encode = (function for _, function in corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = first(spark, docs, SF_DIR).collect()
    scored = score(docs, fit(docs, labels)).collect()
    assert {r.doc_id for r in good} == {r.row.doc_id for r in scored if r.score >= 0.7}
    kept = rules(spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in kept} <= {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 50}
    single = dedup(spark, docs, SF_DIR).collect()
    groups = simhash.near_duplicate_groups(docs).collect()
    assert sorted(r.doc_id for r in single) == sorted({r.component_id for r in groups})
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    held = {r.doc_id for r in decontaminate.contaminated(docs, benchmark).collect()}
    left = clean(spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in left} == {r.doc_id for r in docs.collect()} - held and held
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    encoded = encode(spark, docs, SF_DIR).collect()
    assert {r.doc_id: r.text for r in encoded} == texts and all(r.n_tokens == len(r.ids) for r in encoded)
    for rows in (good, kept, single, left):
        assert set(rows[0].asDict()) == set(docs.columns)


def test_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_tokens", "ids", "text"] and not found.isEmpty()
    # Only the last stage's rows are left.
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["byte_level_bpe"]
