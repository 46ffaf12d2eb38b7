import hashlib
import random

import pytest

from starwise.llm import fingerprint
from starwise.llm.fingerprint import ImatchConfig


def texts(seed=9, rows=120):
    rng = random.Random(seed)
    words = [f"term{n}" for n in range(300)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(10, 80))) for _ in range(rows)]
    return out + [out[0], out[1], "", "", "x", "éàü 二 \U0001f600 abc"]


def likeness(a, b):
    if a.startswith("text:") or b.startswith("text:"):
        return float(a == b)
    pairs = [(x, y) for x, y in zip(a.split("."), b.split(".")) if (x, y) != ("-", "-")]
    return sum(x == y for x, y in pairs) / len(pairs)


@pytest.mark.parametrize("config", [ImatchConfig(), ImatchConfig(rows_per_part=7), ImatchConfig(rows_per_part=5, ranges=3)])
def test_edited_texts_and_likeness(spark, config):
    found = texts()
    rows = [(n * n - 50, text or None) for n, text in enumerate(found)]  # uneven ids, null for empty
    result = fingerprint.compare_edited(spark.createDataFrame(rows, "doc_id bigint, text string"), config).collect()
    by = {r.doc_id: r for r in result}
    assert len(result) == len(by) == len(rows)
    order = sorted(rows, reverse=True)
    for (key, text), (after, following) in zip(order, order[1:] + order[:1]):
        text, following, row = text or "", following or "", by[key]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == pytest.approx(likeness(row.fingerprint, row.edited_fingerprint))
        assert row.near_next == pytest.approx(likeness(row.fingerprint, by[after].fingerprint))
    for key, text in rows:
        same = {by[other].fingerprint for other, copy in rows if copy == text}
        assert len(same) == 1
    assert sum(r.near_edited > r.near_next for r in result) > 0.7 * len(result)


def test_lexicon_is_the_band(spark, docs_of):
    rows = ["common rare one", "common pair two", "common pair three", "common four, FOUR", None, ""] * 2
    found = fingerprint.lexicon(docs_of(rows), ImatchConfig(least=0.2, most=0.5)).collect()
    hashes = {r.term for r in found}
    pair = spark.sql("SELECT xxhash64('pair') AS x, xxhash64('common') AS y, xxhash64('rare') AS z").first()
    assert pair.x in hashes and pair.y not in hashes and pair.z not in hashes


@pytest.mark.parametrize("changes", [0, 3])
def test_hot_group_stays_in_the_lexicon(spark, docs_of, changes):
    """A third of the rows are copies, or near copies, of one text; its terms are as rare as before."""
    rng = random.Random(12)
    words = [f"term{n}" for n in range(1500)]
    others = [" ".join(rng.sample(words, 40)) for _ in range(400)]
    base = rng.sample(words, 150)
    copies = []
    for _ in range(200):
        copy = list(base)
        for at in rng.sample(range(150), changes):
            copy[at] = rng.choice(words)
        copies.append(" ".join(copy))
    docs = docs_of(others + copies)
    known = {r.term for r in fingerprint.lexicon(docs).collect()}
    own = [spark.sql(f"SELECT xxhash64('{w}') AS x").first().x for w in base[:20]]
    assert sum(x in known for x in own) >= 19
    hot = [r for r in fingerprint.compare_edited(docs).collect() if r.doc_id > 400]
    assert not any(r.fingerprint.startswith("text:") for r in hot)
    assert sum(r.near_next for r in hot) > (0.35 if changes else 0.99) * len(hot[:-1])
    assert min(r.near_edited for r in hot[:-1]) > 0


def test_odd_rows(odd, none):
    result = fingerprint.compare_edited(odd).collect()
    assert len(result) == 8 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in result)
    assert fingerprint.compare_edited(none).count() == 0
    found = fingerprint.fingerprint_documents(odd).collect()
    assert len(found) == 8 and len({r.fingerprint for r in found if r.doc_id == 1}) == 1
    assert len({r.fingerprint for r in found if r.doc_id in (2, 3)}) == 1


def test_no_python_in_the_plan(odd):
    plan = fingerprint.compare_edited(odd)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
