import random
import re

import pytest

from starwise.llm import pii

# The base patterns as they are stated.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text):
            found = match.group()
            digits = re.sub("[^0-9]", "", found)
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(part) <= 255 for part in found.split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, *match.span()))
    return out


def test_base_patterns_against_plain_ones():
    rng = random.Random(3)
    for _ in range(20000):
        text = "".join(rng.choice("0123459.@-+ ()ab%é٣") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "a@" * 50_000, "+1" + " " * 200_000, "1." * 100_000])
def test_long_texts_take_linear_time(text):
    pii.base_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.fixture(scope="module")
def field():
    return pii.default_field()


def test_held_out_rows_of_the_labelled_table(field):
    table = pii.labelled_table(300, seed=77)
    found = pii.find_spans([text for text, _ in table], field)
    wanted = sum(len(spans) for _, spans in table)
    got = [{*base, *added} for base, added in found]
    hits = sum(len(g & set(spans)) for g, (_, spans) in zip(got, table))
    wrong = sum(len(g - set(spans)) for g, (_, spans) in zip(got, table))
    assert hits >= 0.95 * wanted and wrong <= 0.03 * wanted


def test_added_spans(field):
    texts = ["call (988) 555-2485 now", "mail bob (at) mail.example.org, thanks", "version 2.0.1 of 2024-05-12", None, ""]
    found = pii.find_spans(texts, field)
    assert [[(k, t[a:b]) for k, a, b in added] for t, (_, added) in zip(texts, found)] == [
        [("phone", "(988) 555-2485")], [("email", "bob (at) mail.example.org")], [], [], [],
    ]
    assert all(not base for base, _ in found)


def best_by_force(field, numbers):
    """Best allowed label sequence, from all of them."""
    import itertools

    scores = field.scores(numbers)
    best = max(
        itertools.product(range(len(pii.LABELS)), repeat=len(numbers)),
        key=lambda s: scores[0][s[0]] + pii.START[s[0]]
        + sum(scores[n][y] + (field.move[x][y] if pii.ALLOWED[x][y] else -1e4) for n, (x, y) in enumerate(zip(s, s[1:]), 1)),
    )
    return list(best)


def test_viterbi_against_all_sequences(field):
    texts = ["call 555", "x@y.z", "+1 (9", "10.0.0", "", "card"]
    cut = [pii.features(t, [m.span() for m in pii._TOKEN.finditer(t)]) for t in texts]
    for numbers, labels in zip(cut, field.decode(cut)):
        assert labels.tolist() == (best_by_force(field, numbers) if len(numbers) else [])


def test_rows(spark, odd, none):
    found = pii.find_personal_data(odd).collect()
    assert len(found) == 8 and all(not r.base and not r.added for r in found)
    assert pii.find_personal_data(none).count() == 0
    rows = [(1, "a b.c@d.org, +1 (456) 555-2186", 30, "kept"), (2, None, None, None), (3, "clean", 99, "x")]
    clean = pii.redact(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, base string"))
    assert sorted(map(tuple, clean.collect())) == [(1, "a [EMAIL], [PHONE]", 18, "kept"), (2, None, None, None), (3, "clean", 5, "x")]
    assert pii.redact(none).columns == none.columns


def test_query(spark, tmp_path):
    import hashlib

    from starwise.llm.queries import QUERIES

    texts = [
        "a.b@c.org 10.0.0.1 10.0.0.2 4111 1111 1111 1111 +1 (456) 555-2186", None, "clean",
        "call (988) 555-2485, x@y.zz", "Ä\U0001f600 1.2.3.4 999.1.1.1",
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in QUERIES["op9_pii"](spark, str(tmp_path)).collect():
        spans = brute(texts[row.doc_id] or "")
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(s[0] == k for s in spans) for k in PLAIN)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))
        if row.doc_id == 3:
            assert row.spans == "email:21:27,phone:5:19"
