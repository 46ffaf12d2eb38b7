import random

import pytest

from starwise.llm import ngram_join
from starwise.llm.ngram_join import JoinConfig, grams


def brute(rows, threshold=0.8):
    """Links and lowest connected key per row, from all pairs."""
    sets = [set(grams(None if text is None else text.encode(), 5).tolist()) for _, text in rows]
    links, group = [0] * len(rows), list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= threshold * len(a | b) - 1e-12:
                links[i] += 1
                links[j] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    keys = {g: min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in group}
    return sorted((rows[k][0], keys[group[k]], links[k]) for k in range(len(rows)))


def near_copies(seed=5, groups=8, size=9, words=90):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(words)]
        for n in range(size):
            changed = list(base)
            for _ in range(n // 2):
                changed[rng.randrange(words)] = f"new{rng.randint(0, 9)}"
            texts.append(" ".join(changed))
            if n % 3 == 0:
                texts.append(" ".join(changed).upper() + "!")
    return texts + ["short text", "Short, text", "", None, "?!", "?!", "a b c d", "a b c d e"]


@pytest.mark.parametrize("block", [1024, 4])
def test_against_brute_force(docs_of, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)  # 4: buckets of several blocks
    texts = near_copies()
    found = ngram_join.similarity_classes(docs_of(texts)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found) == brute(list(enumerate(texts)))


def test_shape_follows_from_recall():
    bands, rows = JoinConfig().shape
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.9995
    assert JoinConfig(recall=0.9).shape[0] < bands
    assert JoinConfig(threshold=1.0).shape[1] > rows


def test_keep_one(spark, docs_of, odd, none):
    texts = near_copies()
    classes = {c for _, c, _ in brute(list(enumerate(texts)))}
    kept = ngram_join.keep_one(docs_of(texts)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(classes)
    assert all(r.text == texts[r.doc_id] for r in kept)
    left = ngram_join.keep_one(odd)
    assert left.columns == odd.columns
    # the repeated row once, and one of the null and the empty text
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 2, 4, 5, 6]
    assert ngram_join.keep_one(none).count() == 0
    assert ngram_join.similarity_classes(none).count() == 0


def test_odd_rows(odd):
    found = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in ngram_join.similarity_classes(odd).collect())
    assert found == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 2, 1), (3, 2, 1), (4, 4, 0), (5, 5, 0), (6, 6, 0)]


def test_null_keys_stay_apart(spark):
    rows = [(None, "one two three four five six"), (None, "some other words that are here"), (3, "one two three four five six")]
    found = ngram_join.similarity_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.n_links for r in found) == [0, 1, 1]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert kept.count() == 2


def test_plan_has_no_cross_join(docs_of):
    plan = ngram_join.similarity_classes(docs_of(["a b c d e f"]))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
