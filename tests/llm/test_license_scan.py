import random
from difflib import SequenceMatcher
from itertools import combinations

from starwise.llm import license_scan
from starwise.llm.text import words


def test_rising_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        pairs = list(enumerate(rng.sample(range(20), rng.randint(0, 8))))
        longest = max(
            n for n in range(len(pairs) + 1) for c in combinations(pairs, n) if all(x[1] < y[1] for x, y in zip(c, c[1:]))
        )
        found = license_scan.rising(pairs)
        assert len(found) == longest and all(x[1] < y[1] for x, y in zip(found, found[1:]))


def test_alignment_is_a_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        base = [f"w{n}".encode() for n in rng.sample(range(100), 30)]
        changed = [w for w in base if rng.random() > 0.1]
        for _ in range(3):
            changed.insert(rng.randrange(len(changed)), b"new%d" % rng.randint(0, 9))
        pairs = license_scan.align(changed, base)
        assert all(changed[a] == base[b] for a, b in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        # distinct words: the alignment is as long as any
        assert len(pairs) == sum(m.size for m in SequenceMatcher(None, changed, base, False).get_matching_blocks())


def test_hits():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)

    def names(text):
        return [h.template for h in scanner.find(text.encode())]

    assert names("Some words.\nLicensed under the Apache License, Version 2.0.\nMore.") == ["Apache-2.0"]
    assert names("x Licensed UNDER the apache License version 2.0 y " * 3) == ["Apache-2.0"] * 3
    assert names("Licensed under CC BY-NC 4.0. and then all rights reserved") == ["CC-BY-NC-4.0", "All rights reserved"]
    assert names("This program is free software under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("the version of the license was public and under general use") == []
    far = "word " * 5000 + "Released under the MIT License." + " word" * 5000
    (hit,) = scanner.find(far.encode())
    assert (hit.template, hit.coverage) == ("MIT-short", 1.0)
    assert words(far.encode())[hit.start : hit.end] == [b"released", b"under", b"the", b"mit", b"license"]


def test_odd_rows(odd, none):
    found = license_scan.scan_licenses(odd).collect()
    assert len(found) == 8 and not any(r["hits"] for r in found)
    own = license_scan.scan_licenses(odd, {"greek": "beta gamma delta", "empty": ""}).collect()
    assert sorted(len(r["hits"]) for r in own) == [0] * 6 + [1, 1]
    assert license_scan.scan_licenses(none).count() == 0


def test_versions_and_whole_texts():
    full = license_scan.full_texts()
    scanner = license_scan.Scanner(license_scan.TEMPLATES | full, 0.8)

    def names(text):
        return [h.template for h in scanner.find(text.encode())]

    for name, text in (license_scan.TEMPLATES | full).items():  # each is told from its relatives, among other words too
        (hit,) = scanner.find(f"{'prose ' * 40}{text}{' prose' * 40}".encode())
        assert (hit.template, hit.coverage) == (name, 1.0)
    bsd = license_scan.TEMPLATES["BSD-2"]
    assert names(bsd[: len(bsd) // 3]) == ["BSD-opening"]  # too little of any of the family
    assert names("This program is free software under the GNU General Public License, version 2.") == ["GPL-2.0-short"]
    assert names("This program is free software under the GNU General Public License, version 4.") == []
    assert names(license_scan.TEMPLATES["GPL-2.0-header"].replace("version 2", "version 7")) == []


def test_nothing_is_lost_before_the_alignment(monkeypatch):
    """Hits are the same when every window of every template is aligned."""
    rng = random.Random(5)
    short = {name: text for name, text in license_scan.TEMPLATES.items() if len(text) < 2500}
    scanner = license_scan.Scanner(short, 0.8)
    cases = []
    for _ in range(120):
        body = words(rng.choice(list(short.values())).encode())
        rare = {w for w in body if body.count(w) == 1}
        body = [w for w in body if w not in rare or rng.random() > rng.choice([0.0, 0.15, 0.3])]
        for _ in range(rng.randint(0, 3)):  # foreign paragraphs in between
            at = rng.randrange(len(body) + 1)
            body[at:at] = [rng.choice([b"zzz", b"the", b"of", b"software"]) for _ in range(rng.randint(1, 30))]
        cases.append(b" ".join([b"prose"] * rng.randint(0, 40) + body + [b"and the license"] * rng.randint(0, 5)))
    found = [scanner.find(text) for text in cases]
    monkeypatch.setattr(license_scan.Scanner, "_enough", lambda self, name, counts: True)
    assert found == [scanner.find(text) for text in cases]
    assert sum(map(bool, found)) > 40


def test_inserted_paragraph_and_dropped_words():
    scanner = license_scan.Scanner(license_scan.TEMPLATES | license_scan.full_texts(), 0.8)
    name = max((n for n in license_scan.TEMPLATES if n.startswith("MIT")), key=lambda n: len(license_scan.TEMPLATES[n]))
    body = words(license_scan.TEMPLATES[name].encode())
    (hit,) = scanner.find(b" ".join(body[:70] + [b"foreign"] * 20 + body[70:]))
    assert (hit.template, hit.coverage) == (name, 1.0)
    often = [w for w in body if body.count(w) > 1]
    left = list(body)
    for w in [w for w in dict.fromkeys(body) if w not in often][: len(body) // 8]:
        left.remove(w)
    (hit,) = scanner.find(b" ".join(left))
    assert hit.template == name and 0.8 <= hit.coverage < 0.9
