"""Conversation trie, periodic runs and top-k search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF001

from tillroll.llm import periodic, topk, trie
from tillroll.llm import queries as Q

BLANK = re.compile(rb"[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- conversation trie --------------------------------------------------------


def trie_brute(turns):
    """turns: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), (r, x)))
    own = {c: [x[-1] for x in sorted(rows)] for c, rows in own.items()}
    members, ends, built = defaultdict(list), defaultdict(list), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[built[c]].append(c)
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) == len(n) + 1 for m in below)]
        words = lambda n: len([w for w in BLANK.split(n[-1][1].encode()) if w]) if n else 0
        parent = min(members[node[:-1]]) if node else None
        saved = sum((len(members[n]) - 1) * words(n) for n in below)
        out.append((min(cs), len(node), parent, len(cs), len(kids), len(leaves), saved, sha(",".join(map(str, sorted(ends.get(node, [])))))))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def random_turns(seed, convs):
    rng = random.Random(seed)
    says = ["", " ", "a b", "a", "b\tc  d", None, "é ü", "long " * 40]
    out = []
    for c in convs:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            out.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else ["user", "assistant"][t % 2], rng.choice(says[:3]) if rng.random() < 0.8 else rng.choice(says)))
    return out + out[:3]  # repeated rows


SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, words int, conv string"


@pytest.mark.parametrize(("seed", "hot_part"), [(1, 1000), (2, 4)])
def test_trie_brute(spark, monkeypatch, seed, hot_part):
    monkeypatch.setattr(trie, "HOT_PART", hot_part)  # 4: most parents go by the join
    turns = random_turns(seed, [*range(-45, -35), *range(0, 90), *range(110, 118), None])
    df = spark.createDataFrame([(*t, 1, "k", 2, "c") for t in turns], SCHEMA)  # clashing names
    assert trie_got(trie.trie(trie.rebuilt(df))) == trie_brute(turns)


def test_trie_over_tasks(spark):
    """One conversation holds most rows and spans tasks; many identical ones."""
    turns = [(40, i, "user", f"x{i % 7} y") for i in range(300)] + [(41, i, "user", f"x{i % 7} y") for i in range(250)]
    turns += [(c, 0, "user", "hi you") for c in range(5000, 5400)] + [(c, t, "user", f"{t} hi") for c in range(60, 64) for t in range(5)]
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
        keys = trie.prefix_keys(df)
        assert {(r.conv, r.pos) for r in keys.collect()} == {(c, i + 1) for c, i, _, _ in turns}
        assert trie_got(trie.trie(trie.rebuilt(df))) == trie_brute(turns)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trie_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    got = trie.trie(trie.rebuilt(df))
    assert got.columns == COLUMNS and got.count() == 0
    lost = spark.createDataFrame([(next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4), 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert [r.depth for r in trie.trie(trie.rebuilt(lost)).collect()] == [0]  # turnless: the root alone


def test_end_lists_in_pieces(spark):
    ids = list(range(-9000, 9000, 2)) + [10**15]
    ends = spark.createDataFrame([(c, 2, 5, 6) for c in ids] + [(7, 2, 5, 7)], "conv long, depth long, k1 long, k2 long")
    got = {r.k2: r.ends_sha256 for r in trie.end_lists(ends).collect()}
    assert got == {6: sha(",".join(map(str, ids))), 7: sha("7")}


# -- periodic runs --------------------------------------------------------------


def runs_brute(words):
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q) and (s, length) not in found:
                found[s, length] = q
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, letters = rng.choice([0, 3, 5, 30, 120, 700]), rng.choice([1, 2, 3, 50])
    w = [b"%d" % rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.choice([0, 1, 2, 3])):  # stretches with a period
        q = rng.choice([1, 2, 5, 8, 9, 13, 16, 17, 31, 33, 64, 100])
        unit = [b"%d" % rng.randrange(max(letters, 2)) for _ in range(q)]
        at = rng.randrange(len(w) + 1)
        w[at:at] = (unit * 7)[: rng.choice([4 * q - 1, 4 * q, 4 * q + 1, 6 * q])]
    return w


@pytest.mark.parametrize("seed", range(6))
def test_runs_brute(seed):
    rng = random.Random(seed)
    texts = [some_words(rng) for _ in range(40)]
    # a period of any length at all scales, alone and with what comes before
    texts += [[b"%d" % i for i in range(q)] * 4 for q in (1, 2, 3, 7, 8, 9, 15, 16, 17, 32, 33, 63, 64, 65, 128, 129)]
    thue = [b"ab"[bin(i).count("1") % 2 :][:1] for i in range(2048)]
    texts += [thue, (thue[:300] * 5)[:1400]]
    for words, (got_words, got) in zip(texts, periodic.text_runs([b" ".join(w) for w in texts])):
        assert got_words == words and got == runs_brute(words)


def test_runs_of_a_long_text():
    rng = random.Random(9)
    unit = [b"%d" % rng.randrange(9) for _ in range(40_000)]
    text = [b"x"] * 3 + unit * 4 + unit[:17] + [b"y", b"a", b"b"] * 9
    (_, got), = periodic.text_runs([b" ".join(text)])
    assert (3, 160_017, 40_000) in got and (160_020, 27, 3) in got


def collapse_brute(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_op12_against_brute_force(spark):
    got = {r.doc_id: r for r in Q.op12_minimizer_runs(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    planted = 0
    for d in docs:
        words = [w for w in BLANK.split((d.text or "").encode()) if w]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            planted += 1
        runs, r = runs_brute(words), got[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == hashlib.sha256(collapse_brute(words, runs)).hexdigest()
    assert planted and len(got) == len(docs)


def test_runs_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a a a a a a é", "x"), (3, "\n\t", None), (4, "b c " * 50_000, "x"), (4, "b c " * 50_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Runs string")
    got = periodic.with_runs(df)
    assert got.columns == ["doc_id", "text", "runs", "collapsed"]
    found = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in got.select("doc_id", "runs", "collapsed").collect())
    assert found == [("1", [], ""), ("2", [], ""), ("3", [], ""), ("4", [(0, 100_000, 2)], "b c"), ("4", [(0, 100_000, 2)], "b c"), ("None", [(0, 6, 1)], "a é")]
    assert periodic.with_runs(df.limit(0)).count() == 0
    planted = {str(r.doc_id): r.text for r in Q.with_planted_periods(df).collect()}
    assert planted["1"] is None and planted["2"] == "" and planted["None"] == "a a a a a a é"


def test_runs_batches_of_any_size(spark, monkeypatch):
    texts = [" ".join(str(i % 11) for i in range(n)) for n in (5, 60, 400, 0, 43, 44, 45)]
    whole = [list(x[1]) for x in periodic.text_runs([t.encode() for t in texts])]
    assert whole == [runs_brute(t.encode().split()) for t in texts]
    sizes = list(periodic._groups([t.encode() for t in texts]))
    assert sizes == [(0, len(texts))]
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 20)
    cut = list(periodic._groups([t.encode() for t in texts]))
    assert [a for a, _ in cut] == [0, *[b for _, b in cut[:-1]]] and cut[-1][1] == len(texts) and len(cut) > 2


# -- top-k search -------------------------------------------------------------------


def topk_brute(rows, k):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for q, v in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def topk_got(df, k=5):
    return sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0"), k).select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("big", [1.0, 3000.0, 4e12])
def test_topk_brute(spark, big, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(8) * big).round(3).tolist()) for i in range(0, 320)]
    rows[:50] = [(i, [0.5] * 8) for i, _ in rows[:50]]  # ties beyond k
    rows += [(400, None), (401, [1.0, None]), (402, [math.nan] * 8), (450, [math.inf, 1.0]), (None, [1.0] * 8), (451, []), (500, [2.0, -1.5]), (7, [1.0] * 8), (50, [0.25] * 8), (-50, [-0.5] * 8)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, q int, score string, bin int")
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "PACK", 33)
    if big > 1e12:
        df = df.where("vec_id < 60 and vec_id >= 0")
        rows = [r for r in rows if r[0] is not None and 0 <= r[0] < 60]
        with pytest.raises(OverflowError):
            topk_got(df)
        return
    assert topk_got(df.repartition(5)) == topk_brute(rows, 5)


def test_topk_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.5]), (3, [0.5, 0.5]), (2, [0.5, 0.5])], schema)
    assert topk_got(few) == [(0, 1, 2, 128 * 256 + 128 * 128), (0, 2, 3, 128 * 256 + 128 * 128)]
    assert topk_got(few.where("vec_id > 0")) == [] and topk_got(few.limit(0)) == [] and topk_got(few.where("vec_id = 0")) == []


def test_topk_is_exact_beyond_floats(spark):
    """Scores near 2 ** 60, one apart."""
    rows = [(0, [2.0**20, 1 / 256]), (1, [2.0**20, 0.0]), (2, [2.0**20, 1 / 256]), (3, [2.0**20, 2 / 256])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert topk_got(df, 2) == [(0, 1, 3, 2**56 + 2), (0, 2, 2, 2**56 + 1)]


def test_topk_common_vector_sends_k_rows(spark):
    """However many rows tie at the kth score, a task passes on k of them."""
    df = spark.range(0, 3000, 1, 3).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(0.25)).alias("embedding"))
    packs = topk.materialize(topk.packed(df, "vec_id", "embedding", 256, 512), "packs")
    ask = [r.asDict() for r in topk.packed(df.where("vec_id = 50"), "vec_id", "embedding", 256, 4).collect()]
    most, longest = packs.agg(F.max("most"), F.max("longest")).first()
    block = topk.Block(ask, 5, most, longest)
    topk._refine(packs, block)
    assert block.hi[0] - block.lo[0] == 1 and block.lo[0] == 128 * 128 + 64 * 64 and block.above[0] == 0
    assert topk._selected(packs, block).count() <= 5 * packs.rdd.getNumPartitions()
