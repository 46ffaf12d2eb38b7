import random

import numpy as np

from starwise.llm import quality
from starwise.llm.queries import graded


def corpus(rows=300, seed=11):
    rng = random.Random(seed)
    docs, grades = [], []
    for n in range(rows):
        grade = n % 3
        text = [f"w{rng.randint(0, 60)}" + ("%%%" if rng.random() < (0.6, 0.05, 0.0)[grade] else "") for _ in range(60)]
        text += [f"fine{rng.randint(0, 5)}"] * (grade == 2)
        docs.append((n, " ".join(text)))
        grades.append((n, grade))
    return docs, grades


def test_grades_are_learned_in_order(spark):
    docs, grades = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rated = spark.createDataFrame(grades + [(None, 1), (5, None), (6, 9)], "doc_id bigint, grade int")
    model = quality.train(frame.where("doc_id < 200"), rated.where("doc_id < 200 OR doc_id IS NULL"), 3)
    assert np.all(np.diff(model.thresholds) > 0)
    by = dict(grades)
    rows = quality.score(frame.where("doc_id >= 200"), model, 1).collect()
    means = [np.mean([r.expected_grade for r in rows if by[r.doc_id] == g]) for g in range(3)]
    assert means[0] + 0.3 < means[1] < means[2]
    assert np.mean([(r.tail_probability >= 0.5) == (by[r.doc_id] > 0) for r in rows]) > 0.95


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    rows = [(np.array([0, 1, 2]), rng.normal(size=3)) for _ in range(200)]
    truth = np.array([1.5, -1.0, 0.5])
    value = np.array([v @ truth for _, v in rows]) + rng.logistic(size=200)
    grades = (value > -1).astype(int) + (value > 1)
    config = quality.QualityConfig(buckets=4, rounds=400, ridge=1e-4)
    model = quality.fit(rows, grades, 3, config)

    def loss(weights, thresholds):
        tails = 1 / (1 + np.exp(thresholds[None, :] - np.array([weights[a] @ b for a, b in rows])[:, None]))
        bounded = np.hstack([np.ones((200, 1)), tails, np.zeros((200, 1))])
        return -np.log(bounded[np.arange(200), grades] - bounded[np.arange(200), grades + 1]).mean() + config.ridge / 2 * (weights**2).sum()

    best = loss(model.weights, model.thresholds)
    for k in range(3):
        for step in (-0.05, 0.05):
            moved = model.weights.copy()
            moved[k] += step
            assert loss(moved, model.thresholds) > best
    for k in range(2):
        for step in (-0.05, 0.05):
            cuts = model.thresholds.copy()
            cuts[k] += step
            assert loss(model.weights, cuts) > best


def test_odd_rows(spark, odd, none):
    ratings = spark.createDataFrame([], "doc_id bigint, grade int")
    model = quality.train(odd, ratings, 3)
    rows = quality.score(odd, model, 1).collect()
    assert len(rows) == 8 and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert quality.score(none, model, 1).count() == 0


def test_a_repeated_key_is_learned_from_once(spark, monkeypatch):
    docs, grades = corpus(rows=30)
    frame = spark.createDataFrame(docs + [(3, f"copy {n}") for n in range(200)], "doc_id bigint, text string")
    rated = spark.createDataFrame(grades, "doc_id bigint, grade int")
    sizes = []
    monkeypatch.setattr(quality, "fit", lambda rows, grades, *rest: sizes.append((len(rows), len(grades))))
    quality.train(frame, rated, 3)
    assert sizes == [(30, 30)]


def test_grades_need_a_quality(spark):
    rows = [(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, 0), (5, None, 1), (6, 1, None), (7, 0, None)]
    found = graded(spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")).collect()
    assert {r.doc_id: r.grade for r in found} == {1: 0, 2: 1, 3: 2, 4: None, 5: None, 6: None, 7: 0}
