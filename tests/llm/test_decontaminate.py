import random

from starwise.llm import decontaminate
from starwise.llm.text import words


def brute(text, items, size=13):
    found = words((text or "").encode())
    hit, names = set(), set()
    for item, body in items:
        for window in decontaminate.windows(words((body or "").encode()), size):
            for at in range(len(found) - len(window) + 1):
                if tuple(found[at : at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    names.add("null" if item is None else str(item))
    return len(found), hit, sorted(names)


def fixture(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(6)]

    def run(size):
        return [rng.choice(vocabulary) for _ in range(size)]

    items = [(n, " ".join(run(rng.choice([1, 2, 3, 5, 12, 13, 14, 20, 30])))) for n in range(2, 30)]
    items += [(30, ""), (31, None), (None, "Only-Here, word"), (32, items[0][1]), (2, items[0][1]), (2, "second text of two")]
    texts = []
    for _ in range(60):
        body = run(rng.randint(0, 60))
        if rng.random() < 0.6:
            body[len(body) // 2 : len(body) // 2] = (rng.choice(items)[1] or "").split()
        texts.append("; ".join(body).title())
    return texts + [None, "", "only here WORD", "?!"], items


def test_against_brute_force(spark, docs_of, monkeypatch):
    texts, items = fixture()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block_bytes in (1 << 20, 300):  # one block of patterns, and several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
        found = decontaminate.judge(decontaminate.find_contamination(docs_of(texts), benchmark)).collect()
        assert len(found) == len(texts)
        for row in found:
            n, hit, names = brute(texts[row.doc_id], items)
            covered = {x for a, b in row.hits for x in range(a, b)}
            assert (row.n_words, covered, row["items"]) == (n, hit, names)
            assert (row.n_hit, row.n_items) == (len(hit), len(names))
            assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= n)


def test_odd_rows(spark, odd, none):
    benchmark = spark.createDataFrame([(7, "gamma delta")], "item_id int, text string")
    found = decontaminate.judge(decontaminate.find_contamination(odd, benchmark)).collect()
    assert sorted((r.doc_id or 0, r.n_hit) for r in found) == [(0, 0), (1, 2), (1, 2), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0)]
    assert decontaminate.find_contamination(none, benchmark).count() == 0
    nothing = benchmark.limit(0)
    assert {r.n_items for r in decontaminate.judge(decontaminate.find_contamination(odd, nothing)).collect()} == {0}
    kept = decontaminate.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == 6


def test_jumps_skip_positions():
    search = decontaminate.Search(13)
    search.add(tuple(f"p{n}".encode() for n in range(13)), 0)
    looked = []

    class Watched(dict):
        def get(self, key, default=None):
            looked.append(key)
            return super().get(key, default)

    search.shift = Watched(search.shift)
    assert search.find([b"other"] * 1200) == []
    assert len(looked) <= 100  # one look per 12 words


def test_many_blocks_are_loaded_in_turn(spark, docs_of, monkeypatch):
    """No more than a few blocks are held, and the plan does not grow with the benchmark."""
    items = [(f"i{n}", " ".join(f"b{n}x{k}" for k in range(20))) for n in range(40)]
    docs = docs_of([f"some {text} words" for _, text in items] + ["none", None, ""])
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    whole = sorted(map(str, decontaminate.find_contamination(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    found = decontaminate.find_contamination(docs, benchmark)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= decontaminate.BLOCKS_AT_ONCE
    assert sorted(map(str, found.collect())) == whole
