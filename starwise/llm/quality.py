"""Quality classifier: cumulative-link regression of ordered grades on hashed text."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.llm.text import map_slices, row_schema, words
from starwise.runtime import materialize

_MARKS = re.compile(rb"[!-/:-@\[-`{-~]+")


@dataclass(frozen=True)
class QualityConfig:
    """``sample`` bounds the rated rows that are learned from (about that many, by hash of the id)."""

    buckets: int = 1 << 13
    sample: int = 8_000
    rounds: int = 60
    ridge: float = 2e-3
    rate: float = 0.1


@dataclass
class CumulativeLink:
    """P(grade > k) = 1 / (1 + exp(thresholds[k] - x . weights)); the thresholds ascend."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, value: np.ndarray) -> np.ndarray:
        """Probability of a grade above each threshold, one row per value."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - value[:, None], -30, 30)))


def hashed(text: bytes | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of a text: its words, runs of marks, and shape measures.

    Values are square roots of counts, scaled to length 1; a few measures of repetition, marks
    and capitals follow with their own size.
    """
    text = text or b""
    found = words(text)
    marks = _MARKS.findall(text)
    names, counts = np.unique(
        np.array([zlib.crc32(x) % buckets for x in (*found, *(b"mark " + m[:6] for m in marks))], np.int64),
        return_counts=True,
    )
    values = np.sqrt(counts)
    values = values / max(1.0, float(np.linalg.norm(values)))
    size = max(1, len(text))
    lines = text.split(b"\n")
    distinct = len(set(found)) / max(1, len(found))
    pairs = set(zip(found, found[1:]))
    measures = {
        b"words": np.log1p(len(found)) / 8, b"distinct": distinct, b"marks": min(1.0, 8 * sum(map(len, marks)) / size),
        b"upper": sum(map(text.count, (b"A", b"E", b"T", b"N"))) * 4 / size, b"lines": len(set(lines)) / len(lines),
        b"pairs": len(pairs) / max(1, len(found) - 1), b"longest": min(1.0, max(map(len, found), default=0) / 50),
    }
    shape = np.array([zlib.crc32(b"shape " + n) % buckets for n in measures], np.int64)
    return np.concatenate([names, shape]), np.concatenate([values, np.array([*measures.values()], float)])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int, config: QualityConfig) -> CumulativeLink:
    """Maximum likelihood with ridge by Adam; thresholds are a start and positive steps, so they stay ordered."""
    share = [(np.sum(grades > k) + 1) / (len(grades) + 2) for k in range(levels - 1)]
    start = -np.log(np.array(share) / (1 - np.array(share)))
    start = np.maximum.accumulate(start + 1e-3 * np.arange(levels - 1))
    weights, cuts = np.zeros(config.buckets), np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    if not rows:
        return CumulativeLink(weights, start)
    owner = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    names, values = np.concatenate([a for a, _ in rows]), np.concatenate([b for _, b in rows])
    each = np.arange(len(rows))
    state = [np.zeros(config.buckets), np.zeros(config.buckets), np.zeros(levels - 1), np.zeros(levels - 1)]
    for turn in range(1, config.rounds + 1):
        thresholds = np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])]))
        value = np.bincount(owner, values * weights[names], len(rows))
        tails = 1 / (1 + np.exp(np.clip(thresholds[None, :] - value[:, None], -30, 30)))
        bounded = np.hstack([np.ones((len(rows), 1)), tails, np.zeros((len(rows), 1))])
        chance = np.maximum(bounded[each, grades] - bounded[each, grades + 1], 1e-9)
        slope = bounded * (1 - bounded)  # derivative of a tail by the value
        by_value = (slope[each, grades] - slope[each, grades + 1]) / chance
        by_cut = np.zeros(levels + 1)
        np.add.at(by_cut, grades, -slope[each, grades] / chance)
        np.add.at(by_cut, grades + 1, slope[each, grades + 1] / chance)
        reach = np.cumsum(by_cut[1:levels][::-1])[::-1]  # a step moves all thresholds after it
        pulls = (
            np.bincount(names, values * by_value[owner], config.buckets) / len(rows) - config.ridge * weights,
            reach * np.concatenate([[1.0], np.exp(cuts[1:])]) / len(rows),
        )
        for k, (target, pull) in enumerate(zip((weights, cuts), pulls)):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * pull
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * pull**2
            target += config.rate * (state[2 * k] / (1 - 0.9**turn)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**turn)) + 1e-9)
    return CumulativeLink(weights, np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])])))


def train(docs: DataFrame, ratings: DataFrame, levels: int, key: str = "doc_id", config: QualityConfig = QualityConfig()) -> CumulativeLink:
    """Fit to ``ratings`` (``key``, ``grade`` from 0 to ``levels`` - 1); other or null grades are left out.

    Of the texts under one key the lowest is learned from.

    Hashing runs on the executors; the bounded sample's hashed rows are fitted on the driver.
    Without ratings the weights are 0 and every grade is as likely as any other.
    """
    rated = ratings.where(F.col(key).isNotNull() & F.col("grade").between(0, levels - 1)).groupBy(key).agg(F.max("grade").cast("int").alias("grade"))
    total = rated.count()
    if total > config.sample:
        rated = rated.where(F.pmod(F.xxhash64(key, F.lit(2)), F.lit(1 << 30)) < int((1 << 30) * config.sample / total))
    rows = docs.select(key, "text").join(F.broadcast(rated), key)
    rows = materialize(rows.groupBy(key, "grade").agg(F.min("text").alias("text")).select("text", "grade"))  # one text per key

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [hashed(t, config.buckets) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        names = pa.array([a.astype(np.uint16).tobytes() for a, _ in found], pa.binary())
        values = pa.array([b.astype(np.float32).tobytes() for _, b in found], pa.binary())
        return pa.RecordBatch.from_arrays([names, values, batch.column("grade")], ["names", "values", "grade"])

    table = map_slices(rows, work, "names binary, values binary, grade int").collect()  # config.sample rows
    made = [(np.frombuffer(r.names, np.uint16).astype(np.int64), np.frombuffer(r["values"], np.float32).astype(float)) for r in table]
    return fit(made, np.array([r.grade for r in table], int), levels, config)


def score(docs: DataFrame, model: CumulativeLink, tail: int, key: str = "doc_id", config: QualityConfig = QualityConfig()) -> DataFrame:
    """``key``, ``expected_grade`` and ``tail_probability`` (of grade ``tail`` or more) for every row.

    A null or empty text has shape measures only. Null keys and repeated rows come back as they
    are; no other column is read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [hashed(t, config.buckets) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        tails = sent.value.tails(np.array([float(sent.value.weights[a] @ b) for a, b in found]))
        columns = [batch.column(key), pa.array(tails.sum(1)), pa.array(tails[:, tail - 1])]
        return pa.RecordBatch.from_arrays(columns, [key, "expected_grade", "tail_probability"])

    return map_slices(docs.select(key, "text"), work, row_schema(docs, key, "expected_grade double, tail_probability double"))
