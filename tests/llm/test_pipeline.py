from pathlib import Path

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from starwise.llm import pii
from starwise.llm.ngram_join import grams
from starwise.llm.text import words

SMALL_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL_DIR).exists(), reason="the given tables are not here")


def test_every_operator_is_registered():
    names = list(queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert len(seen[name]) == docs.count()
        assert docs.columns == columns or name == "bpe"
    rows = {n: s for n, s in seen.items()}

    def sets(found):
        return {k: set(grams((r.text or "").encode(), 5).tolist()) for k, r in found.items()}

    kept = sets(rows["near_duplicates"])
    assert not any(len(a & b) >= 0.8 * len(a | b) for i, a in kept.items() for j, b in kept.items() if i < j)
    for key, found in sets(rows["toxicity"]).items():
        if key not in kept:  # whatever left is linked to a row of its input
            assert any(j != key and len(found & b) >= 0.8 * len(found | b) for j, b in sets(rows["toxicity"]).items())

    benchmark = spark.read.parquet(f"{SMALL_DIR}/benchmark.parquet").collect()
    windows = set()
    for item in benchmark:
        body = words((item.text or "").encode())
        windows.update(tuple(body[i : i + 13]) for i in range(max(1, len(body) - 12)) if body)
    for key, row in rows["near_duplicates"].items():
        body, hit = words((row.text or "").encode()), set()
        for size in {len(w) for w in windows}:
            for i in range(len(body) - size + 1):
                if tuple(body[i : i + size]) in windows:
                    hit.update(range(i, i + size))
        assert (key in rows["decontamination"]) == (not hit or 20 * len(hit) < len(body))

    assert set(rows["personal_data"]) == set(rows["decontamination"]) == set(rows["bpe"])
    for key, row in rows["personal_data"].items():
        assert not pii.base_spans(row.text or "")
        before = rows["decontamination"][key].text
        assert pii.base_spans(before or "") or row.text == before or "[" in row.text


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL_DIR).count() > 100
