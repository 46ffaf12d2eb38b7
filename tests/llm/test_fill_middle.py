import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starwise.llm import fill_middle
from starwise.llm.queries import QUERIES

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def expected(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(rng):
    pick = lambda: rng.choice(["ab", "Zed", " ", "é", "二", "\U0001f600", "\n", "<", "<S", "M>", ">", "0", "\x00"])
    return "".join(pick() for _ in range(rng.randint(0, 60)))


TEXTS = ["", None, "a", "é", "<P>", "x <M> y", "one two <", "word " * 40_000, "二" * 70_000 + "abc", "z" * 200_000]


def test_query(spark, tmp_path):
    rng = random.Random(4)
    rows = list(enumerate(TEXTS + [random_text(rng) for _ in range(400)])) + [(None, "no id here"), (3, "é"), (3, "é")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.withColumns({"n": F.lit("x"), "form": F.lit(1), "told": F.lit(2)}).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = sorted(((d, *(e := expected(d, t))[:4], sha(e[4]), sha(t or "")) for d, t in rows), key=repr)
    assert sorted((tuple(r) for r in QUERIES["op13_fill_middle"](spark, str(tmp_path)).collect()), key=repr) == wanted
    assert {row[2] for row in wanted} == {"plain", "psm", "spm"}


def test_odd_rows(odd, none):
    made = fill_middle.fill_middle(odd)
    again = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=repr)
    assert fill_middle.fill_middle(none).count() == 0


def sets():
    rng = np.random.default_rng(1)
    yield np.arange(10)
    yield np.arange(200_000)  # runs over several containers
    yield np.arange(0, 400_000, 2)  # bitmaps
    yield np.sort(rng.choice(10_000_000, 3000, replace=False))  # arrays, many containers
    yield np.sort(rng.choice(300_000, 120_000, replace=False))
    yield np.concatenate([np.arange(70_000), np.arange(500_000, 500_040), np.arange(600_001, 800_000, 3)])


@pytest.mark.parametrize("offsets", list(sets()))
def test_select_gives_every_offset(offsets):
    found = fill_middle.BoundarySet(offsets)
    assert len(found) == len(offsets)
    ask = np.unique(np.concatenate([np.arange(min(70, len(offsets))), np.linspace(0, len(offsets) - 1, 900).astype(int)]))
    assert [found.select(int(k)) for k in ask] == offsets[ask].tolist()


def test_all_kinds_of_containers_are_met():
    kinds = {type(fill_middle.BoundarySet(offsets).containers[0]).__name__ for offsets in sets()}
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}


def test_token_ends():
    rng = random.Random(9)
    for text in ["", "abc", *(random_text(rng) for _ in range(300))]:
        assert fill_middle.token_ends(text).tolist() == [m.end() for m in UNITS.finditer(text)]


def test_other_marks(docs_of):
    config = fill_middle.FillConfig("[P]", "(S)", "|M|", seed=7, rate=100, suffix_first=50)
    texts = ["some words to cut", "a [P] b", "<P> is plain text here", "x" * 9]
    made = fill_middle.fill_middle(docs_of(texts), config=config)
    rows = made.select("doc_id", "form", fill_middle.restored(F.col("output"), F.col("form"), config).alias("text")).collect()
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(texts))
    assert {r.doc_id for r in rows if r.form == "plain"} == {1}
