"""Personal data: exact patterns, and a linear-chain conditional random field that adds spans."""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.llm.text import map_slices, row_schema

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))
FEATURES = 1 << 14
Span = tuple[str, int, int]

# The base patterns. Look-behinds and possessive runs only spare futile starts.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_TRIGGER = re.compile(r"[0-9@]|[\[(] ?at ?[\])]")
REACH = 40  # characters around a trigger that its sequence takes in, up to the next white space


def luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches, found from each @: a local part is the whole run before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns by kind and start; a match that fails its check is dropped."""
    found: list[Span] = [("email", *x) for x in _emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m.group())]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if _is_card(m.group())]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if _is_phone(m.group(), 9)]
    return found


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _is_ip(text: str) -> bool:
    return all(int(part.lstrip("0")[:4] or 0) <= 255 for part in text.split("."))


def _is_card(text: str) -> bool:
    return 13 <= len(digits := _digits(text)) <= 19 and luhn(digits)


def _is_phone(text: str, least: int) -> bool:
    return least <= len(_digits(text)) <= 15


def _holds(kind: str, text: str) -> bool:
    """The exact check that a span of the random field has to pass."""
    if kind == "email":
        return bool(re.fullmatch(r"[\w.%+-]+ ?(@|[\[(] ?at ?[\])]) ?[\w-]+( ?(\.|[\[(] ?dot ?[\])]) ?[\w-]+)+", text))
    if kind == "ip":
        parts = _DIGIT.split(text) and re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts)
    return _is_card(text) if kind == "card" else _is_phone(text, 7)


# The small labelled table: {x} marks a span of that kind, all else is no personal data.
TEMPLATES = (
    "write to {email} today", "mail: {email}, thanks", "contact {email} or call {phone}", "e-mail {email}.",
    "from {ip} at noon", "host {ip} answered", "client ip {ip}, port 8080", "server {ip} down",
    "card {card} expired", "paid with {card}, approved", "visa {card} and phone {phone}", "number {card}.",
    "call {phone} now", "tel {phone}", "phone: {phone}, office", "fax {phone}. Regards", "mobile {phone} or {email}",
    "thhe {email} anon", "re {ip} onnt", "er {card} the", "thon {phone} nd", "la {phone}, éeau", "und {card} ver",
    "on {date} we met", "version {version} of it", "under CC BY-NC {version}.", "License, Version {version}.",
    "version {small}.", "section {small} and {small}", "it cost {money} then", "at {time} sharp",
    "token = \"{hex}\" the", "password={hex} er", "key {key} on", "page {small} of {small}", "isbn {isbn}",
    "order {id} shipped", "id {id}, row {small}", "from {year} to {year}", "{money} or {money} each",
    "see chapter {version}", "the {small} things on {date} at {time}", "value {real} and {real}", "range {small}-{small}",
)


def _draw(kind: str, rng: random.Random) -> str:
    def digits(count: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(count))

    def name() -> str:
        return "".join(rng.choice("abdehilmnorstu") for _ in range(rng.randint(2, 8)))

    if kind == "email":
        local = rng.choice([name(), f"{name()}.{name()}", f"{name()}.{digits(2)}", f"{name()}_{digits(1)}"])
        at, dot = rng.choice([("@", "."), ("@", "."), (" (at) ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)")])
        return f"{local}{at}{name()}{rng.choice(['', digits(1)])}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"
    if kind == "ip":
        return rng.choice([".", ".", ".", " . "]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        head = rng.choice("3456") + digits(14)
        last = next(d for d in "0123456789" if luhn(head + d))
        whole = head + last
        return rng.choice(["", " ", "-", ".", "/"]).join(whole[i : i + 4] for i in range(0, 16, 4))
    if kind == "phone":
        return rng.choice([
            f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}",
            f"{digits(3)}-{digits(3)}-{digits(4)}", f"+{digits(2)} {digits(3)} {digits(7)}", f"00{digits(2)} {digits(2)} {digits(7)}",
            f"0{digits(3)} {digits(3)} {digits(4)}", f"+{digits(2)}-{digits(2)}-{digits(4)}-{digits(4)}",
        ])
    year, month, day = rng.randint(1900, 2030), rng.randint(1, 12), rng.randint(1, 28)
    return {
        "date": rng.choice([f"{year}-{month:02}-{day:02}", f"{day}/{month}/{year}", f"{day}.{month}.{year}"]),
        "version": rng.choice([f"{digits(1)}.{digits(1)}", f"{digits(1)}.{digits(2)}.{digits(1)}"]),
        "small": str(rng.randint(0, 999)), "money": rng.choice([f"${digits(3)}.{digits(2)}", f"{digits(2)},{digits(2)} EUR"]),
        "time": f"{day % 24}:{month:02}", "hex": "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 40]))),
        "key": "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
        "isbn": f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", "id": digits(rng.randint(5, 9)),
        "year": str(year), "real": f"{digits(1)}.{digits(rng.randint(3, 8))}",
    }[kind]


def labelled_table(rows: int = 420, seed: int = 9) -> list[tuple[str, list[Span]]]:
    """(text, spans): drawn from the templates with invented values."""
    rng, out = random.Random(seed), []
    for n in range(rows):
        text, spans = "", []
        for part in re.split(r"(\{\w+\})", TEMPLATES[n % len(TEMPLATES)]):
            if part.startswith("{"):
                value = _draw(part[1:-1], rng)
                if part[1:-1] in KINDS:
                    spans.append((part[1:-1], len(text), len(text) + len(value)))
                part = value
            text += part
        out.append((text, spans))
    return out


# Words that may announce personal data.
CUES = frozenset("at dot mail email e contact write call tel phone fax mobile card visa number ip host server client from to".split())


def _shape(token: str) -> str:
    if token[0].isdigit():
        return f"9{min(len(token), 6)}"
    if token[0].isalpha():
        case = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        return case + str(min(len(token), 3))
    return token


def features(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    """Numbers of the word-shape features of each token, hashed into a fixed range."""
    found = [text[a:b] for a, b in tokens]
    shapes = ["<", "<", *map(_shape, found), ">", ">"]
    glued = ["-", *("-" if b == c else " " for (_, b), (c, _) in zip(tokens, tokens[1:])), "-", "-"]
    rows = []
    for n, token in enumerate(found):
        a, b, c, d, e = shapes[n : n + 5]
        low = token.lower()
        g, h = glued[n], glued[n + 1]
        before = found[n - 1].lower() if n else "<"
        names = (
            "1", f"s{c}", f"l{b}{g}{c}", f"r{c}{h}{d}", f"m{b}{g}{c}{h}{d}", f"f{a}{b}{c}", f"n{c}{d}{e}",
            f"w{low if low in CUES else '-'}", f"p{before if before in CUES else '-'}{c}",
            f"d{token[:2]}{len(token)}" if c[0] == "9" and len(token) < 4 else "d",
        )
        rows.append([zlib.crc32(name.encode()) % FEATURES for name in names])
    return np.array(rows, np.int32).reshape(len(tokens), 10)


def _logsumexp(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis))


# A span starts with its B label; an I label only follows the same kind's B or I.
ALLOWED = np.array([[y[0] != "I" or (x[0] != "O" and x[2:] == y[2:]) for y in LABELS] for x in LABELS])
START = np.array([0.0 if y[0] != "I" else -1e4 for y in LABELS])


@dataclass
class RandomField:
    """Weights of a linear-chain conditional random field over word shapes."""

    emit: np.ndarray  # FEATURES x labels
    move: np.ndarray  # labels x labels

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        return self.emit[numbers].sum(-2)

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best label sequence of each feature matrix: Viterbi over batches of like length."""
        out: list[np.ndarray] = [np.empty(0, np.int8)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda n: len(sequences[n]))
        move = np.where(ALLOWED, self.move, -1e4)
        at = 0
        while at < len(order):
            batch, longest = [], 0
            while at < len(order) and (not batch or (len(batch) + 1) * len(sequences[order[at]]) <= 50_000):
                longest = max(longest, len(sequences[order[at]]))
                batch.append(order[at])
                at += 1
            if not longest:
                continue
            sizes = np.array([len(sequences[n]) for n in batch])
            scores = np.zeros((len(batch), longest, len(LABELS)))
            for row, n in enumerate(batch):
                scores[row, : sizes[row]] = self.scores(sequences[n])
            back = np.zeros((len(batch), longest, len(LABELS)), np.int8)
            best = scores[:, 0] + START
            for step in range(1, longest):
                total = best[:, :, None] + move
                back[:, step] = total.argmax(1)
                moved = total.max(1) + scores[:, step]
                best = np.where((step < sizes)[:, None], moved, best)
            labels = np.zeros((len(batch), longest), np.int8)
            now, each = best.argmax(1), np.arange(len(batch))
            for step in range(longest - 1, -1, -1):
                inside = step < sizes
                labels[inside, step] = now[inside]
                now = np.where(inside, back[each, step, now], now)
            for row, n in enumerate(batch):
                out[n] = labels[row, : sizes[row]]
        return out


def train(table: list[tuple[str, list[Span]]], rounds: int = 40, rate: float = 0.25, ridge: float = 1e-4) -> RandomField:
    """Fit the field to a labelled table by gradient ascent (Adam) on the log-likelihood."""
    rows = [(text, [m.span() for m in _TOKEN.finditer(text)], spans) for text, spans in table]
    rows = [row for row in rows if row[1]]
    longest, size = max(len(tokens) for _, tokens, _ in rows), len(LABELS)
    numbers = np.zeros((len(rows), longest, 10), np.int32)
    gold, mask = np.zeros((len(rows), longest), int), np.zeros((len(rows), longest), bool)
    for n, (text, tokens, spans) in enumerate(rows):
        numbers[n, : len(tokens)], mask[n, : len(tokens)] = features(text, tokens), True
        for kind, start, end in spans:
            inside = [k for k, (a, b) in enumerate(tokens) if start <= a and b <= end]
            gold[n, inside] = LABELS.index(f"I-{kind}")
            gold[n, inside[:1]] = LABELS.index(f"B-{kind}")
    used, numbers = np.unique(numbers, return_inverse=True)
    numbers = numbers.reshape(len(rows), longest, 10)
    sizes, each = mask.sum(1), np.arange(len(rows))
    weights = [np.zeros((len(used), size)), np.zeros((size, size))]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    target = [np.zeros_like(w) for w in weights]
    np.add.at(target[0], numbers[mask], np.eye(size)[gold[mask]][:, None, :])
    np.add.at(target[1], (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
    for turn in range(1, rounds + 1):
        move = np.where(ALLOWED, weights[1], -1e4)
        scores = weights[0][numbers].sum(2)
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + START
        for step in range(1, longest):
            moved = _logsumexp(ahead[:, step - 1, :, None] + move, 1) + scores[:, step]
            ahead[:, step] = np.where(mask[:, step, None], moved, ahead[:, step - 1])
        for step in range(longest - 2, -1, -1):
            moved = _logsumexp(move + (scores[:, step + 1] + behind[:, step + 1])[:, None, :], 2)
            behind[:, step] = np.where(mask[:, step + 1, None], moved, 0)
        total = _logsumexp(ahead[each, sizes - 1], 1)
        chance = np.exp(ahead + behind - total[:, None, None])
        gradient = [target[0].copy(), target[1].copy()]
        np.add.at(gradient[0], numbers[mask], -chance[mask][:, None, :])
        pairs = ahead[:, :-1, :, None] + move + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        gradient[1] -= np.exp(pairs[mask[:, 1:]]).sum(0)
        for k in range(2):
            slope = gradient[k] / len(rows) - ridge * weights[k]
            means[k] = 0.9 * means[k] + 0.1 * slope
            squares[k] = 0.99 * squares[k] + 0.01 * slope**2
            weights[k] += rate * (means[k] / (1 - 0.9**turn)) / (np.sqrt(squares[k] / (1 - 0.99**turn)) + 1e-8)
    emit = np.zeros((FEATURES, size), np.float32)
    emit[used] = weights[0]
    return RandomField(emit, weights[1].astype(np.float32))


@cache
def default_field() -> RandomField:
    return train(labelled_table())


def _windows(text: str) -> list[tuple[int, int]]:
    """Stretches of text within reach of a digit, an @ or a written-out one, cut at white space.

    Tokens beyond them carry no shape of personal data; whole texts are covered.
    """
    out: list[list[int]] = []
    for match in _TRIGGER.finditer(text):
        if out and match.end() + REACH <= out[-1][1]:
            continue
        start, end = max(0, match.start() - REACH), min(len(text), match.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    for window in out:
        while 0 < window[0] and not text[window[0] - 1].isspace():
            window[0] -= 1
        while window[1] < len(text) and not text[window[1]].isspace():
            window[1] += 1
    joined: list[tuple[int, int]] = []
    for start, end in out:
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def find_spans(texts: list[str | None], field: RandomField) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) per text. Added spans overlap no base span and pass an exact check."""
    texts = [text or "" for text in texts]
    owners, tokens, sequences = [], [], []
    for n, text in enumerate(texts):
        for start, end in _windows(text):
            cut = [m.span() for m in _TOKEN.finditer(text, start, end)]
            owners.append(n)
            tokens.append(cut)
            sequences.append(features(text, cut))
    out = [(base_spans(text), []) for text in texts]
    for n, cut, labels in zip(owners, tokens, field.decode(sequences)):
        base, added = out[n]
        begins = np.flatnonzero(labels % 2 == 1)
        for at in begins.tolist():
            stop = at + 1
            while stop < len(labels) and labels[stop] == labels[at] + 1:
                stop += 1
            kind, start, end = LABELS[labels[at]][2:], cut[at][0], cut[stop - 1][1]
            if all(end <= a or b <= start for _, a, b in base) and _holds(kind, texts[n][start:end]):
                added.append((kind, start, end))
    for _, added in out:
        added.sort(key=lambda span: (KINDS.index(span[0]), span[1]))
    return out


def find_personal_data(docs: DataFrame, key: str = "doc_id", labelled: list | None = None) -> DataFrame:
    """``key``, ``base`` and ``added``: arrays of (kind, start, end) in code points, end exclusive.

    ``base`` has the exact patterns, ``added`` what the random field finds beyond them. The field
    is trained on the driver from ``labelled`` rows (text, spans), by default the small table of
    this module. A null text is an empty one; null keys and repeated rows come back as they are.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(labelled) if labelled else default_field())
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def spans(found: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in found], pa.list_(item))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find_spans(batch.column("text").to_pylist(), field.value)
        columns = [batch.column(key), spans([b for b, _ in found]), spans([a for _, a in found])]
        return pa.RecordBatch.from_arrays(columns, [key, "base", "added"])

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return map_slices(docs.select(key, "text"), work, row_schema(docs, key, f"base {kind}, added {kind}"))


def redact(docs: DataFrame, labelled: list | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, such as ``[EMAIL]``.

    Overlapping spans are replaced together, under the first one's kind. Rows, other columns and
    null texts stay; a column ``n_chars`` is set to the new length where the text changed.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(labelled) if labelled else default_field())
    at = docs.columns.index("text")

    def clean(text: str, spans: list[Span]) -> str:
        out, end = [], 0
        for kind, start, stop in sorted(spans, key=lambda span: (span[1], -span[2])):
            if start >= end:
                out += [text[end:start], f"[{kind.upper()}]"]
            end = max(end, stop)
        return "".join([*out, text[end:]])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        found = find_spans(texts, field.value)
        new = [clean(t, base + added) if base or added else t for t, (base, added) in zip(texts, found)]
        return batch.set_column(at, "text", pa.array(new, batch.schema.field("text").type))

    result = map_slices(docs, work, docs.schema)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        result = result.withColumn("n_chars", changed.cast(dict(docs.dtypes)["n_chars"]))
    return result
