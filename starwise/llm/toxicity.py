"""Toxicity of texts by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.llm.ngram_join import similarity_classes
from starwise.llm.text import held_out, map_batches, map_slices, row_schema, words
from starwise.runtime import materialize

# Closed word classes in the four languages of the corpus.
SEED_INSULTS = (
    "idiot idiots stupid moron morons loser losers scum trash worthless pathetic disgusting clown dumb imbecile "
    "dumm idiotin trottel abschaum arschloch widerlich wertlos imbécile débile ordure connard minable "
    "estúpido estúpida imbécil basura escoria inútil"
).split()
THREATS = (
    "kill murder hurt destroy beat stab shoot strangle töten umbringen verletzen vernichten schlagen "
    "tuer blesser détruire frapper matar herir destruir golpear"
).split()
TARGETS = (
    "you your he she they him them his her their du dich dir ihr euch er sie tu te toi vous il elle ils elles "
    "tú ti usted ustedes él ella ellos ellas"
).split()
NEGATIONS = "not no never neither nor cannot nicht kein keine nie niemals ne pas jamais non nunca jamás ni".split()
REPORTS = (
    "said says say told called calls wrote quoted claimed sagte sagt nannte schrieb behauptete "
    "dit disait appelé écrit affirmé dijo dice llamó escribió afirmó"
).split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
SEED_WEIGHT = 4.0
HEADS = range(4, 10)  # letters of a word beginning
PATTERNS = tuple(product(("insult", "threat"), ("plain", "aimed", "negated", "reported")))


@dataclass
class Transducer:
    """Arcs from (state, input symbol) to (state, output, weight); an arc that is missing loops and echoes."""

    start: object
    arcs: dict[tuple, tuple] = field(default_factory=dict)

    def step(self, state: object, symbol: object) -> tuple[object, object, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def compose(first: Transducer, second: Transducer, symbols: Iterable[object]) -> Transducer:
    """The transducer that feeds the first one's output to the second; weights multiply."""
    out = Transducer((first.start, second.start))
    todo, seen, symbols = [out.start], {out.start}, list(symbols)
    while todo:
        state = todo.pop()
        for symbol in symbols:
            one, between, weight = first.step(state[0], symbol)
            two, output, more = second.step(state[1], between)
            out.arcs[state, symbol] = ((one, two), output, weight * more)
            if (one, two) not in seen:
                seen.add((one, two))
                todo.append((one, two))
    return out


def negation(scope: int = 3) -> Transducer:
    """Marks harm within ``scope`` words after a negation."""
    t = Transducer(0)
    for left in range(scope + 1):
        t.arcs[left, NEGATION] = (scope, OTHER, 1.0)
        t.arcs[left, END] = (0, END, 1.0)
        for symbol in (OTHER, TARGET, REPORT):
            t.arcs[left, symbol] = (max(0, left - 1), symbol, 1.0)
        for symbol in (INSULT, THREAT):
            t.arcs[left, symbol] = (max(0, left - 1), (symbol, "negated") if left else symbol, 1.0)
    return t


def reported_speech() -> Transducer:
    """Marks harm after a verb of saying, up to the end of the clause."""
    t = Transducer(False)
    for harm in (INSULT, THREAT):
        t.arcs[True, harm] = (True, (harm, "reported"), 1.0)
    for state in (False, True):
        t.arcs[state, REPORT] = (True, OTHER, 1.0)
        t.arcs[state, END] = (False, END, 1.0)
    return t


def clauses() -> Transducer:
    """Adds up a clause: its state is (target met, pattern so far); END gives the pattern out.

    Harm that is aimed outranks plain harm, which outranks reported and negated harm.
    """
    rank = {"negated": 0, "reported": 1, "plain": 2}
    t = Transducer((False, None))
    contexts = [None, *product((INSULT, THREAT), rank)]
    for aimed, held in product((False, True), contexts):
        state = (aimed, held)
        t.arcs[state, TARGET] = ((True, held), None, 0.0)
        t.arcs[state, OTHER] = (state, None, 0.0)
        for harm, context in product((INSULT, THREAT), rank):
            new = (harm, context)
            if held is not None and (rank[held[1]], held[0]) >= (rank[context], harm):
                new = held
            symbol = harm if context == "plain" else (harm, context)
            t.arcs[state, symbol] = ((aimed, new), None, 1.0)
        if held is not None:
            context = "aimed" if aimed and held[1] == "plain" else held[1]
            pattern = ("insult" if held[0] == INSULT else "threat", context)
            t.arcs[state, END] = ((False, None), pattern, 1.0)
        else:
            t.arcs[state, END] = ((False, None), None, 0.0)
    return t


def clause_machine() -> Transducer:
    symbols = range(7)
    return compose(compose(negation(), reported_speech(), symbols), clauses(), symbols)


_CLAUSE_END = re.compile(rb"[.,;:!?()\n\"]+")
# Words of the closed classes, and learned arcs beside them.
CLOSED = {
    **{w.encode(): (REPORT, 0.0) for w in REPORTS},
    **{w.encode(): (NEGATION, 0.0) for w in NEGATIONS},
    **{w.encode(): (TARGET, 0.0) for w in TARGETS},
    **{w.encode(): (THREAT, SEED_WEIGHT) for w in THREATS},
    **{w.encode(): (INSULT, SEED_WEIGHT) for w in SEED_INSULTS},
}


class Lexicon(dict):
    """Transducer from words to (symbol, weight): whole words first, then word beginnings."""

    def __init__(self, insults: dict[str, float], beginnings: dict[str, float]):
        super().__init__()
        self.insults, self.beginnings = insults, beginnings
        self.renew()

    def __reduce__(self):
        return Lexicon, (self.insults, self.beginnings)

    def renew(self) -> None:
        self.clear()
        self.update(CLOSED)
        self.update({word.encode(): (INSULT, weight) for word, weight in self.insults.items()})

    def __missing__(self, word: bytes) -> tuple[int, float]:
        try:
            text = word.decode()
        except UnicodeDecodeError:
            text = ""
        found = max((self.beginnings.get(text[:k], 0.0) for k in HEADS if k < len(text)), default=0.0)
        self[word] = out = (INSULT, found) if found else (OTHER, 0.0)
        return out


class Grammar:
    """The composed machine, its lexicon, and the weights that turn patterns into a score."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None = None):
        self.lexicon, self.weights = lexicon, weights
        self.machine = clause_machine()

    def matches(self, text: str | None) -> list[tuple[tuple[str, str], float]]:
        """(pattern, weight) of every clause with harm in it."""
        low = (text or "").lower().encode("utf-8", "replace")
        if len(self.lexicon) > 400_000:
            self.lexicon.renew()
        get = self.lexicon.__getitem__
        if not any(symbol == INSULT or symbol == THREAT for symbol, _ in map(get, words(low))):
            return []
        out, arcs, state = [], self.machine.arcs, self.machine.start
        for clause in _CLAUSE_END.split(low):
            total = 0.0
            for symbol, weight in map(get, words(clause)):
                state, _, factor = arcs[state, symbol]
                total += weight * factor
            state, pattern, _ = arcs[state, END]
            if pattern is not None:
                out.append((pattern, total))
        return out

    def features(self, text: str | None) -> tuple[int, ...]:
        """Per pattern, the weight of its clauses in steps of 2, up to 10 steps."""
        total = dict.fromkeys(PATTERNS, 0.0)
        for pattern, weight in self.matches(text):
            total[pattern] += weight
        return tuple(min(10, math.ceil(total[pattern] / 2)) for pattern in PATTERNS)

    def score(self, text: str | None) -> float:
        value = float(np.dot(self.weights, design(self.features(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def design(row: tuple[int, ...]) -> list[int]:
    """1, then the steps of all insults and all threats, then those aimed, negated and reported."""
    by = dict(zip(PATTERNS, row))
    kinds = [sum(v for (kind, _), v in by.items() if kind == k) for k in ("insult", "threat")]
    return [1, *kinds, *(sum(v for (_, c), v in by.items() if c == context) for context in ("aimed", "negated", "reported"))]


# What the grammar assumes before it sees labels, in the order of ``design``.
PRIOR = np.array([-4.0, 2.1, 2.1, 0.2, -0.5, -0.5])


def fit_weights(table: list[tuple[tuple[int, ...], int, int]], ridge: float = 0.5) -> np.ndarray:
    """Logistic weights by Newton steps from counted feature rows (features, toxic, clean)."""
    weights = PRIOR.copy()
    if not table:
        return weights
    x = np.array([design(row) for row, _, _ in table], float)
    toxic, clean = np.array([t for _, t, _ in table], float), np.array([c for _, _, c in table], float)
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - (toxic + clean) * chance) - ridge * (weights - PRIOR)
        curve = (x * ((toxic + clean) * chance * (1 - chance))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights = weights + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return weights


@dataclass(frozen=True)
class ToxicityConfig:
    """``sample`` bounds the labelled rows that are learned from (about that many, by hash of the id)."""

    sample: int = 20_000
    arcs: int = 5_000
    odds: float = 2.0  # least logarithm of the odds of an arc
    evidence: float = 35.0
    seed_evidence: float = 20.0


def _training_rows(docs: DataFrame, labels: DataFrame, key: str, config: ToxicityConfig) -> DataFrame:
    """(key, text, toxic) of labelled rows outside the held-out fifth, one of each class of copies.

    Copies have the same label and a Jaccard index of their 5-gram sets of 0.8 or more, checked on
    the full sets; rows that only share a passage all stay.
    """
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    learned = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & (crc % 5 != 0))
    learned = learned.groupBy(key).agg(F.max("toxic").alias("toxic"))
    total = learned.count()
    if total > config.sample:
        share = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30))
        learned = learned.where(share < int((1 << 30) * config.sample / total))
    rows = docs.select(key, "text").join(F.broadcast(learned), key)  # bounded by config.sample
    rows = materialize(rows.groupBy(key, "toxic").agg(F.min("text").alias("text")))
    kept = [similarity_classes(rows.where(label), key) for label in ("toxic = 1", "toxic <> 1")]
    kept = kept[0].union(kept[1]).where(F.col(key) == F.col("class_id")).select(key)
    return rows.join(kept, key, "left_semi")


def learn_lexicon(rows: DataFrame, config: ToxicityConfig) -> Lexicon:
    """Insults from labelled ``rows`` (text, toxic): words and word beginnings that tell toxic texts.

    Counted are texts per unit, summed over the cluster; kept are at most ``config.arcs`` units
    with much higher and statistically certain (G-test) odds in toxic texts. A beginning must be
    shared by four such words or more, and yields to a longer one that is as certain.
    """
    totals = rows.agg(F.expr("count_if(toxic = 1)").alias("t"), F.expr("count_if(toxic <> 1)").alias("c")).first()
    if not totals.t or not totals.c:
        return Lexicon({}, {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def out() -> pa.RecordBatch:
            names = list({*toxic, *clean})
            numbers = [pa.array([c[w] for w in names], pa.int64()) for c in (toxic, clean)]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *numbers], ["unit", "pos", "neg"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = b" ".join(words((text or "").lower().encode("utf-8", "replace"))).decode("utf-8", "ignore")
                found = {w for w in found.split() if 3 <= len(w) <= 40}
                found.update([f"{w[:k]}*" for w in found for k in HEADS if k < len(w)])
                (toxic if label == 1 else clean).update(found)
                if len(toxic) + len(clean) > 500_000:
                    yield out()
                    toxic.clear(), clean.clear()
        yield out()

    counted = map_batches(rows.select("text", "toxic"), count, "unit string, pos bigint, neg bigint")
    found = counted.groupBy("unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    found = materialize(found.where("pos > neg * 0.2"))
    is_head = F.col("unit").endswith("*")
    lengths = F.array(*map(F.lit, HEADS))
    parts = found.where(~is_head).select("unit", F.explode(lengths).alias("k")).where("k < char_length(unit)")
    spread = parts.groupBy(F.concat(F.expr("left(unit, k)"), F.lit("*")).alias("unit")).agg(F.count(F.lit(1)).alias("n_words"))
    heads = found.where(is_head).join(spread.where("n_words >= 4"), "unit")
    pos, neg = F.col("pos"), F.col("neg")
    base = totals.t / (totals.t + totals.c)
    n = pos + neg
    gain = 2 * (pos * F.log(pos / (n * base)) + F.when(neg > 0, neg * F.log(neg / (n * (1 - base)))).otherwise(0.0))
    odds = F.log((pos + 0.5) / (totals.t + 1)) - F.log((neg + 0.5) / (totals.c + 1))

    def best(units: DataFrame, least: float) -> dict[str, tuple[float, int]]:
        certain = units.where((pos > 0) & (odds >= config.odds)).where(gain >= least)
        top = certain.orderBy(gain.desc(), "unit").limit(config.arcs).select("unit", "pos", odds.alias("odds"))
        return {row.unit.rstrip("*"): (float(min(8.0, row.odds)), row.pos) for row in top.collect()}

    beginnings = best(heads, config.evidence)
    yields = {head[:-1] for head, (_, n) in beginnings.items() if n >= 0.9 * beginnings.get(head[:-1], (0, math.inf))[1]}
    plain, seeds = found.where(~is_head), F.col("unit").isin(*SEED_INSULTS)
    insults = best(plain.where(~seeds), config.evidence) | best(plain.where(seeds), config.seed_evidence)
    return Lexicon(
        {word: weight for word, (weight, _) in insults.items()},
        {head: weight for head, (weight, _) in beginnings.items() if head not in yields},
    )


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", config: ToxicityConfig = ToxicityConfig()) -> Grammar:
    """Learn the insult arcs and the pattern weights from ``labels`` (``key``, ``toxic``).

    Without labels, the closed classes and the prior weights are used.
    """
    rows = materialize(_training_rows(docs, labels, key, config))
    grammar = Grammar(learn_lexicon(rows, config))
    plain = docs.sparkSession.sparkContext.broadcast(grammar)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [plain.value.features(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.list_(pa.int32())), batch.column("toxic").cast(pa.int32())], ["row", "toxic"]
        )

    table = map_slices(rows.select("text", "toxic"), work, "row array<int>, toxic int").groupBy("row").agg(
        F.expr("count_if(toxic = 1)").alias("t"), F.expr("count_if(toxic <> 1)").alias("c")
    )
    grammar.weights = fit_weights([(tuple(r.row), r.t, r.c) for r in table.collect()])  # a row per kind of text, not per text
    return grammar


def score(docs: DataFrame, grammar: Grammar, key: str = "doc_id") -> DataFrame:
    """``key``, ``held_out`` and ``score`` for every row; only the text enters the score.

    A null or empty text has no clause and gets the base score. Null keys and repeated rows come
    back as they are; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(grammar)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [sent.value.score(text) for text in batch.column("text").to_pylist()]
        out = [held_out(k) for k in batch.column(key).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(out), pa.array(scores, pa.float64())], [key, "held_out", "score"])

    return map_slices(docs.select(key, "text"), work, row_schema(docs, key, "held_out boolean, score double"))


def reject(docs: DataFrame, grammar: Grammar, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(grammar)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([sent.value.score(t) < threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    return map_slices(docs, work, docs.schema)
