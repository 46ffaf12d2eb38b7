import random

import pytest

from starwise.llm import toxicity
from starwise.llm.text import held_out


def corpus(seed=6, rows=600):
    """Invented prose; toxic texts hold words of a family that clean ones never have."""
    rng = random.Random(seed)
    syllables = ["ba", "do", "ri", "mu", "te", "lo", "san", "ven"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    docs, labels = [], []
    for n in range(rows):
        text = [word() for _ in range(rng.randint(5, 60))]
        toxic = n % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice([f"grk{word()}", "scum"]))
        docs.append((n, " ".join(text).capitalize() + "."))
        labels.append((n, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    table = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    return toxicity.train(frame, table), frame, dict(labels)


def test_held_out_accuracy(learned):
    grammar, docs, labels = learned
    rows = [r for r in toxicity.score(docs, grammar).collect() if r.held_out]
    assert len(rows) > 80 and all(r.held_out == held_out(r.doc_id) for r in rows)
    right = sum((r.score >= 0.5) == bool(labels[r.doc_id]) for r in rows)
    assert right >= 0.97 * len(rows)
    assert any(head.startswith("grk") for head in grammar.lexicon.beginnings)


def test_clauses_are_told_apart():
    grammar = toxicity.Grammar(toxicity.Lexicon({}, {}), toxicity.PRIOR)
    patterns = {
        "You are an idiot.": ("insult", "aimed"),
        "What an idiot": ("insult", "plain"),
        "This is not an idiot": ("insult", "negated"),
        "He said she is a moron": ("insult", "reported"),
        "I will kill you": ("threat", "aimed"),
    }
    for text, pattern in patterns.items():
        assert [p for p, _ in grammar.matches(text)] == [pattern], text
    assert [p for p, _ in grammar.matches("Not so. An idiot, though; you moron!")] == [("insult", "plain"), ("insult", "aimed")]
    assert grammar.matches("He said no word. A fine day") == [] == grammar.matches(None)
    assert grammar.score("You are an idiot.") > grammar.score("This is not an idiot") > grammar.score("a fine day")


def test_composition_equals_running_both():
    rng = random.Random(8)
    first, second = toxicity.negation(), toxicity.reported_speech()
    both = toxicity.compose(first, second, range(7))
    for _ in range(300):
        one, two, joint = first.start, second.start, both.start
        for symbol in (rng.randrange(7) for _ in range(12)):
            one, between, w = first.step(one, symbol)
            two, out, v = second.step(two, between)
            joint, got, weight = both.step(joint, symbol)
            assert (got, weight) == (out, w * v)


def test_odd_rows(spark, odd, none, learned):
    grammar = learned[0]
    found = toxicity.score(odd, grammar).collect()
    base = grammar.score("")
    assert len(found) == 8 and all(0 <= r.score <= 1 for r in found)
    assert [r.score for r in found if r.doc_id in (2, 3)] == [base, base]
    kept = toxicity.reject(odd, grammar)
    assert kept.columns == odd.columns and kept.count() == 8
    assert toxicity.score(none, grammar).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    untrained = toxicity.train(odd, labels)
    assert untrained.score("you are an idiot") >= 0.5 > untrained.score("a fine day")


def test_copies_count_once(spark):
    """A toxic text copied often does not make its common words insults."""
    docs, labels = corpus(rows=300)
    odd_words = "zanzibar kilimanjaro wakanda " * 8
    docs += [(1000 + n, odd_words + "scum") for n in range(60)]
    labels += [(1000 + n, 1) for n in range(60)]
    grammar = toxicity.train(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    )
    assert grammar.score("a trip to zanzibar and kilimanjaro") < 0.5


def test_only_real_copies_leave_the_training_rows(spark):
    """Rows that share a passage, or are alike under another label, are all learned from."""
    rng = random.Random(5)
    passage = " ".join(f"shared{n}" for n in range(12))
    whole = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(200)]
    texts = [f"{text} {passage}" for text in whole]
    texts += [f"{texts[0]} more", texts[0], texts[1]]  # near copy, copy, copy under the other label
    ids = [n for n in range(1000) if not held_out(n)][: len(texts)]
    toxic = [n % 2 for n in range(200)] + [0, 0, 0]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame(list(zip(ids, toxic)), "doc_id bigint, toxic int")
    found = toxicity._training_rows(docs, labels, "doc_id", toxicity.ToxicityConfig()).collect()
    assert sorted(r.doc_id for r in found) == [*ids[:200], ids[202]]
    assert {r.doc_id: r.toxic for r in found} == {k: t for k, t in zip(ids, toxic) if k not in ids[200:202]}
