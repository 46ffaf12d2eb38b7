import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starwise.llm import filter_audit
from starwise.llm.queries import QUERIES

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(docs):
    """Failed filters of every row, as written in the contract."""
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        found += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        earlier = any((t or "") == text and d is not None and doc_id is not None and d < doc_id for d, t, _ in docs)
        out.append(found + "E" * earlier)
    return out


def brute(docs, good, toxic):
    """Apply every order, document by document."""
    failed, parts = fails(docs), [source or "" for _, _, source in docs]
    out = {}
    for part in set(parts):
        own = [n for n in range(len(docs)) if parts[n] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = set(own)
            for step, letter in enumerate(order, 1):
                here = {n for n in left if letter in failed[n]}
                before = [n for n in own if letter in failed[n] and n not in left]
                left -= here
                shapley[letter] += len(here)
                out[part, order, step] = [
                    len(left), len(here), len(before), sum(failed[n] == letter for n in own),
                    sum(docs[n][0] in good for n in here), sum(docs[n][0] in toxic for n in here),
                ]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                out[part, order, step].append(shapley[letter])
    return out


LONG = " ".join(f"w{k}" for k in range(80))
DOCS = [
    (1, LONG, "a"), (2, LONG, "b"), (2, LONG, "b"), (3, LONG, "a"), (1, LONG, "a"), (4, None, None), (5, "", ""),
    (6, "AB cd $", "a"), (7, "x " * 70, "b"), (8, "X# " * 70, "b"), (9, "x " * 70, "c"), (None, LONG, "a"), (None, "x", None),
    (10, "Ünï cödé é" * 30, "c"), (11, "one\x0btwo\x1cthree " * 40, "c"), (0, "late | low id", "a"), (12, LONG * 300, "d"),
]


def write(spark, folder, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    frame.withColumns({"mask": F.lit("x"), "part": F.lit(1), "n": F.lit(None).cast("int")}).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_query_against_every_order_applied(spark, tmp_path):
    labels = [(1, 1, 0), (1, None, None), (2, 0, 1), (3, 1, None), (6, None, 1), (None, 1, 1), (8, 1, 1), (8, 0, 0)]
    write(spark, tmp_path, DOCS, labels)
    found = {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in QUERIES["op11_filter_audit"](spark, str(tmp_path)).collect()}
    assert found == brute(DOCS, {1, 3, 8}, {2, 6, 8})


def test_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert QUERIES["op11_filter_audit"](spark, str(tmp_path)).count() == 0


def test_copies_of_a_hot_text_are_counted_before_they_move(spark, tmp_path):
    write(spark, tmp_path, [(k, "same", "a") for k in range(3000)] + [(-1, "same", "b")], [(5, 1, 1)])
    rows = QUERIES["op11_filter_audit"](spark, str(tmp_path)).where("filter_order = 'EABCD' and step = 1").collect()
    assert {(r.part, r.removed, r.kept, r.good_lost) for r in rows} == {("a", 3000, 0, 1), ("b", 0, 1, 0)}


@pytest.mark.parametrize("size", [1, 2, 4, 6])
def test_removal_steps_are_those_of_the_orders(size):
    rng = np.random.default_rng(size)
    masks = rng.random((50, size)) < 0.4
    orders = filter_audit.orders_of("ABCDEF"[:size])
    steps = filter_audit.removal_steps(masks, filter_audit.positions_of(orders))
    for mask, row in zip(masks, steps):
        for order, step in zip(orders, row):
            hit = [n for n, k in enumerate(order, 1) if mask[k]]
            assert step == (hit[0] if hit else size + 1)


def test_counts_add_up(spark):
    counts = spark.createDataFrame([("p", m, 3 * m + 1, m) for m in range(8)], "part string, mask int, documents long, bad long")
    rows = filter_audit.audit(counts, "XYZ", ["bad"]).collect()
    assert len(rows) == 18
    for order in {r.filter_order for r in rows}:
        own = sorted((r for r in rows if r.filter_order == order), key=lambda r: r.step)
        assert own[-1].kept == 1 and sum(r.removed for r in own) == sum(3 * m + 1 for m in range(1, 8))
        assert sum(r.bad_lost for r in own) == sum(range(8))
    with pytest.raises(ValueError):
        filter_audit.audit(counts, "ABCDEFGH")
