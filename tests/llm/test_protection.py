"""Personal data against the plain patterns and a plain version of the measure."""

import hashlib
import math
import random
import re
import string

import pytest

from ratelake.llm import pii

from .texts import corpus, frame

PLAIN = {  # as the rules state them
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [(kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(kind, m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def noisy(rng):
    parts = ["4432507379035540", "+1 (386) 555-3733", "a.b@c-d.example.com", "10.0.300.1", "1.2.3.4.5.6.7.8.9", "@", "+",
             ".", "-", " ", "é", "x@y", "x@y.z@w.v", "0" * 20, "255.255.0.1", "4432-5073 7903 5540", "()", "12", "\n", "𝒳", "%"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))


@pytest.mark.parametrize("seed", range(4))
def test_base_patterns(seed):
    rng = random.Random(seed)
    alphabet = "0123456789+-.@ ()aB%é"
    for _ in range(3000):
        text = noisy(rng) if rng.random() < 0.7 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert [(pii.KINDS[k], a, b) for k, a, b, _ in pii.entities(text)] == plain_spans(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "@" * 300_000, "+1" + "(" * 300_000, "1." * 150_000, "a@" * 150_000):
        assert pii.entities(text) == [] or text.startswith("1.")


def test_digest_rows(spark):
    rng = random.Random(9)
    rows = corpus(2, 60) + [(1000 + k, noisy(rng) + " mail to ann.lee@corp.example.com now " + noisy(rng)) for k in range(40)]
    rows += [(None, "call +1 (386) 555-3733"), (7, None), (7, ""), (7, "10.0.0.1"), (8, "word " * 30_000 + "10.0.0.1")]
    got = pii.digest(pii.find(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = []
    for i, text in rows:
        spans = plain_spans(text)
        n = [sum(k == kind for k, *_ in spans) for kind in PLAIN]
        want.append((str(i), *n, hashlib.sha256(listed(spans).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == sorted(want)
    for r in got:
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("term:"))
        assert hashlib.sha256(base.encode()).hexdigest() == r["base_sha256"]
        assert r["n_terms"] == r["spans"].count("term:")


def plain_terms(rows):
    """(row, start, end, general) by counting in the plainest way."""

    def term(word):
        return word.strip(string.punctuation).lower()

    held, near, owners = [], [], []
    for _, text in rows:
        text = text or ""
        spans = plain_spans(text)
        names = {(a, b): (k + ":" + (text[a:b].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", text[a:b]))) for k, a, b in spans}
        places = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        terms = {term(text[a:b]) for a, b in places} - {""}
        held.append(terms | {t[:4] + "*" for t in terms})
        owners.append(set(names.values()))
        own = []
        for (a, b), entity in names.items():
            before = [p for p in places if p[1] < a and p[0] >= a - 256]
            after = [p for p in places if p[0] > b and p[1] <= b + 256]
            for s, e in before[-5:] + after[:5]:
                if all(e < x or s > y for x, y in names) and term(text[s:e]):
                    lead = len(text[s:e]) - len(text[s:e].lstrip(string.punctuation))
                    own.append((entity, term(text[s:e]), s + lead, s + lead + len(text[s:e].strip(string.punctuation))))
        near.append(own)
    n = len(rows)

    def tells(entity, word):
        both = sum(any(e == entity and word in (t, t[:4] + "*") for e, t, *_ in own) for own in near)
        c, w = sum(entity in o for o in owners), sum(word in h for h in held)
        return both >= 2 and c < n and math.log2(both * n / (c * w)) >= 0.8 * math.log2(n / c)

    out = set()
    for row, own in enumerate(near):
        marks = {}
        for entity, t, a, b in own:
            if tells(entity, t):
                marks.setdefault((a, b, t), []).append(tells(entity, t[:4] + "*"))
        out |= {(row, a, b, None if any(gone) else t[:4] + "*") for (a, b, t), gone in marks.items()}
    return out


def spies():
    rng = random.Random(5)
    filler = [f"w{k}" for k in range(40)]
    rows = []
    for k in range(120):
        text = " ".join(rng.choice(filler) for _ in range(20))
        if k % 10 == 0:
            text += " the Falcon's zeppelin agent7 +1 (386) 555-3733, (secretive) w1 w2"
        if k % 10 == 1:
            text += " zeppelins secrets elsewhere"
        rows.append((k, text))
    return rows + [(None, None), (500, ""), (501, None)]


def test_disclosing_terms(spark):
    rows = spies()
    got = {(r["doc_id"], t["start"], t["end"], t["general"]) for r in pii.find(frame(spark, rows)).collect() for t in r["terms"]}
    ids = [i for i, _ in rows]
    want = {(ids[row], a, b, g) for row, a, b, g in plain_terms(rows)}
    assert got == want
    words = {rows[i][1][a:b] for i, a, b, _ in got}
    assert {"zeppelin", "secretive", "agent7"} <= words and not words & {"w1", "w2"}
    assert {i for i, *_ in got} == set(range(0, 120, 10))


def test_sanitised_text(spark):
    rows = spies()
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert got[0].endswith("<term> <term> zepp* <term> <phone>, (secr*) w1 w2"), got[0]
    assert got[1] == rows[1][1] and got[500] == "" and got[501] is None


def test_empty_table(spark):
    assert pii.digest(pii.find(frame(spark, []))).collect() == []
    assert pii.sanitise(frame(spark, [])).collect() == []
