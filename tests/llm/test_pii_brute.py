"""Discovered personal data against a brute-force pattern-instance scoring,
and texts with very many matches."""

import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from tests.llm.test_operators import PII_RE, luhn

from tillroll.llm import pii

SPLIT = re.compile(r"[\x20\x09-\x0D\x01]+")


def valid(k, m):
    d = re.sub("[^0-9]", "", m)
    return [True, k == 1 and all(int(x) <= 255 for x in m.split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]


def matches(pattern, text):
    """(start, end, match, gap before, gap after)."""
    found = list(re.finditer(pattern, text))
    cuts = [0, *[x for m in found for x in m.span()], len(text)]
    return [(m.start(), m.end(), m[0], text[cuts[2 * i] : m.start()], text[m.end() : cuts[2 * i + 3]]) for i, m in enumerate(found)]


def brute(docs):
    """{id: sorted (s, k, e)} of all spans, and what was added to the base."""
    plain = lambda t: re.sub("[0-9]", "0", t.lower())
    base, occ, words = {}, [], Counter()
    for i, t in docs:
        words.update(re.split(r"[\x20\x09-\x0D]+", plain(t)))
        hits = [(k, *m) for k, p in enumerate(PII_RE) for m in matches(p, t) if valid(k, m[2])]
        base[i] = sorted((s, k, e) for k, s, e, *_ in hits)
        masked = list(t)
        for s, _, e in base[i]:
            masked[s:e] = "\x01" * (e - s)
        for s, _, m, b, a in matches(pii.CANDIDATE, "".join(masked)):
            m = m.rstrip("._%+/-")
            if len(m) >= 5:
                hits.append((None, s, s + len(m), m, b, a))
        for k, s, e, m, b, a in hits:
            b, a = ([w for w in SPLIT.split(plain(x)) if w] for x in (b[-64:], a[:64]))
            occ.append((i, k, re.sub(r"[\x20().-]", "", m.lower()), m.lower(), s, e, b[-2] if len(b) > 1 else None, b[-1] if b else None, a[0] if a else None))
    edges, anchor = {}, {}
    for _, k, inst, _, _, _, l2, l1, r1 in occ:
        for name, parts, a in (("l", [l1], l1), ("ll", [l2, l1], l1), ("lr", [l1, r1], l1), ("r", [r1], r1 and ">" + r1)):
            if a and re.search(r"[^\W\d_]{2}", a):
                p = (name, *[x for x in parts if x is not None])
                anchor[p] = a
                old = edges.get((p, inst))
                edges[p, inst] = old if k is None else k if old is None else min(old, k)
    seeds = defaultdict(Counter)
    for (p, _), k in edges.items():
        if k is not None:
            seeds[p][k] += 1
    beside = Counter(a for _, k, *_, l1, r1 in occ if k is not None for a in (l1, r1 and ">" + r1) if a)
    sure = {a for a in beside if beside[a] >= pii.MIN_ANCHOR_SHARE * max(words[a.removeprefix(">")], beside[a])}
    good = {p for p, c in seeds.items() if max(c.values()) >= pii.MIN_SEEDS and anchor[p] in sure}
    live = {e: k for e, k in edges.items() if e[0] in good}
    score = {e: [float(k == j) for j in range(4)] for e, k in live.items()}
    for _ in range(pii.TURNS):
        by = defaultdict(list)
        for (p, _), s in score.items():
            by[p].append(s)
        conf = {p: [sum(c) / len(c) for c in zip(*ss)] for p, ss in by.items()}
        late = defaultdict(lambda: [1.0] * 4)
        for (p, inst), k in live.items():
            if k is None:
                late[inst] = [x * (1 - min(c, 1 - 1e-9)) for x, c in zip(late[inst], conf[p])]
        score = {(p, inst): [max(float(k == j), pii.DAMPING * (1 - late[inst][j]) if inst in late else 0.0) for j in range(4)] for (p, inst), k in live.items()}
    found = {}
    for (_, inst), s in score.items():
        if live[_, inst] is None:
            v, k = max((x, -j) for j, x in enumerate(s))
            assert math.isclose(v, pii.MIN_SCORE, abs_tol=1e-6) is False  # nothing hangs on rounding
            if v >= pii.MIN_SCORE:
                found[inst] = min(found.get(inst, 9), -k)
    added = defaultdict(set)
    for i, k, inst, m, s, e, *_ in occ:
        if k is None and inst in found and ("@" in m if found[inst] == 0 else len(re.sub("[^0-9]", "", m)) >= 4):
            added[i].add((s, found[inst], e))
    return {i: sorted([*base[i], *added[i]]) for i in base}, added


def table(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    seed_of = [lambda: f"{word()}@{word()}.org", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), lambda: "4539578763621486", lambda: f"+44 {digits(10)}"]
    unseen = [lambda: f"{word()}@{word()}", lambda: f"host-{digits(4)}-{digits(3)}", lambda: f"AC{digits(12)}", lambda: f"0{digits(3)}/{digits(6)}"]
    slots = [("mail to {}", "write {} today"), ("server address {}", "ping {} now"), ("card number {}", "charge {} once"), ("hotline {}", "call {} please")]
    docs = []
    for i in range(220):
        parts = [word() for _ in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(4)):
            k = rng.randrange(4)
            what = seed_of[k]() if rng.random() < 0.6 else unseen[k]()
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(slots[k]).format(what) if rng.random() < 0.85 else what)
        if rng.random() < 0.3:  # tokens with digits that are nobody's
            parts.insert(rng.randrange(len(parts) + 1), f"item {digits(6)} of {word()}{digits(3)}")
        docs.append((i, rng.choice([" ", "\n", ", "]).join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_spans_against_brute_force(spark, seed):
    docs = table(seed)
    want, added = brute(docs)
    got = {r.doc_id: sorted((x.s, x.k, x.e) for x in r.spans) for r in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(map(len, added.values())) > 20 and len({k for a in added.values() for _, k, _ in a}) > 1
    assert got == want


@pytest.mark.parametrize("chunk", [2, 3, 256])
def test_chunks_of_any_size(spark, monkeypatch, chunk):
    monkeypatch.setattr(pii, "CHUNK", chunk)
    texts = [" ".join(f"a{i}@é{i}.org b.org,x{i}@b.org" for i in range(n)) for n in (0, 1, 2, 3, 7)] + ["+44 20 7946 0001 4539578763621486 1.2.3.4 +49 171 123 4567"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [sorted((m[0], k, m[1]) for k, p in enumerate(PII_RE) for m in matches(p, t) if valid(k, m[2])) for t in texts]
    got = {r.doc_id: [(x.s, x.k, x.e) for x in r.base] for r in pii.find_pii(df).collect()}
    assert [got[i] for i in range(len(texts))] == want

    def masked(t, spans):
        at, out = 0, ""
        for s, k, e in spans:
            out += (t[at:s] + f"[{pii.KINDS[k].upper()}]") if s >= at else ""
            at = max(at, e)
        return out + t[at:]

    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert [clean[i] for i in range(len(texts))] == [masked(t, w) for t, w in zip(texts, want)]


def test_a_text_with_very_many_matches(spark):
    """Megabytes of addresses in one text."""
    text = " ".join(f"user{i}@mail{i % 97}.example.org" for i in range(140_000))
    assert len(text) > 4_000_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    r = pii.find_pii(df).first()
    assert len(r.base) == 140_000 and r.base[-1].e == len(text)
    assert pii.redact(df).first().text == " ".join(["[EMAIL]"] * 140_000)
    assert time.time() - began < 180
