"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Four strict patterns (e-mail, IPv4 address, card number, phone number) give
the seeds.  The words around the seeds become lexical patterns; a bipartite
graph of patterns and the identifier-like tokens that stand in them is
scored in turns -- a pattern by the mean score of its instances, an instance
by the patterns that hold it -- and tokens that high-confidence patterns
discover are reported under the patterns' kind, besides the seeds.

A pattern is lexical context only if the word next to the slot (its anchor)
mostly stands beside identifiers; "of the" before an address isn't one.  For
that, the words of the whole corpus are counted.

Defined cases: a null text is empty; a null id is kept; repeated rows give
repeated results; an empty table gives an empty result; other columns are
ignored.  Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import materialize, no_text, unused, wide_key

KINDS = ("email", "ip", "card", "phone")

# Every start inside a run that failed from its first character fails too, so
# runs are entered at their start, or where the last match ended (\G).
# Possessive quantifiers match the same and never back off.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a kind's pattern to be tried on it.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
#: Identifier-like tokens: with a digit or an @, not inside a valid strict match.
CANDIDATE = r"(?<![A-Za-z0-9@._%+/-])(?=[A-Za-z._%+/-]*+[0-9@])[A-Za-z0-9@._%+/-]{5,}+"
WORD = r"[^\x20\x09-\x0D]+"

#: Production parameters of the bootstrapping.
MIN_SEEDS = 3
MIN_ANCHOR_SHARE = 0.2
MIN_SCORE = 0.75
DAMPING = 0.85
TURNS = 3

#: Matches of a text that are folded at a time.
CHUNK = 256

SPAN = "array<struct<s:int,k:int,e:int,m:string,before:string,after:string>>"


def _luhn(digits: Column) -> Column:
    rev = F.reverse(digits)

    def worth(i: Column) -> Column:
        c = F.substring(rev, i, F.lit(1)).cast("int")
        twice = F.when(c > 4, 2 * c - 9).otherwise(2 * c)
        return F.when(i % 2 == 0, twice).otherwise(c)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _only_valid(kind: str) -> Column:
    return F.filter(kind, lambda x: _valid(kind, x["m"]))


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return m.rlike(rf"^(?:{part}\.){{3}}{part}$")
    if kind == "card":
        digits = F.regexp_replace(m, r"[\x20-]", "")
        n = F.length(digits)
        return F.when((n >= 12) & (n <= 19), _luhn(digits)).otherwise(False)
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return (n >= 9) & (n <= 15)


def _chunked(items: Column) -> Column:
    """The array in arrays of ``CHUNK``, in order; none of an empty or null one.

    An array that grows while another is folded is copied for each element,
    and a substring is counted from its text's start.  So texts with many
    matches are folded chunk by chunk, and cut into the chunks' parts first:
    what is left to copy is a chunk, or a number for each chunk."""
    n = F.size(items)
    chunk = lambda j: F.slice(items, j * CHUNK + 1, CHUNK)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")), chunk)).otherwise(F.slice(F.array(items), 1, 0))


def _before_each(values: str, plus) -> Column:
    """For each value what ``plus`` makes of 0 and the values before it, and of all last."""
    zero = F.struct(F.lit(0).alias("to"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct(plus(a["to"], x).alias("to"), F.concat(a["out"], F.array(a["to"])).alias("out"))
    return F.aggregate(values, zero, step, lambda a: F.concat(a["out"], F.array(a["to"])))


def _located(df: DataFrame, text: str, pattern: str, hint: Column, rank: int, out: str) -> DataFrame:
    """All matches of ``pattern`` with offsets: what lies between matches and
    the matches themselves, their lengths summed up in turn."""
    pieces, hits, steps, chunks, sums, starts = unused(df, "_pieces", "_hits", "_steps", "_chunks", "_sums", "_starts")
    df = df.withColumn(hits, F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).withColumn(
        pieces, F.when(F.size(hits) > 0, F.split(text, pattern, -1))
    )
    p = F.col(pieces)
    found = F.transform(
        hits,
        lambda m, i: F.struct(
            F.length(p[i]).alias("gap"), F.length(m).alias("n"), m.alias("m"),
            F.right(p[i], F.lit(64)).alias("before"), F.left(p[i + 1], F.lit(64)).alias("after"),
        ),
    )
    df = df.withColumn(steps, F.when(F.size(pieces) > 0, found)).withColumn(chunks, _chunked(F.col(steps)))
    df = df.withColumn(sums, F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["gap"] + x["n"])))
    df = df.withColumn(starts, _before_each(sums, lambda a, x: a + x))

    def step(a: Column, x: Column) -> Column:
        s = a["pos"] + x["gap"]
        one = F.struct(
            s.alias("s"), F.lit(rank).alias("k"), (s + x["n"]).alias("e"), x["m"].alias("m"),
            x["before"].alias("before"), x["after"].alias("after"),
        )
        return F.struct((s + x["n"]).alias("pos"), F.concat(a["out"], F.array(one)).alias("out"))

    def placed(c: Column, j: Column) -> Column:
        return F.aggregate(c, F.struct(F.get(starts, j).alias("pos"), F.array().cast(SPAN).alias("out")), step, lambda a: a["out"])

    return df.withColumn(out, F.flatten(F.transform(chunks, placed))).drop(pieces, hits, steps, chunks, sums, starts)


def _replaced(df: DataFrame, text: str, spans: str, instead, out: str) -> DataFrame:
    """``df`` with ``out``: the text with each of the sorted spans (s, e, ...)
    replaced by ``instead(start, end, span)``, where ``start`` is behind the
    spans before it.  A null or empty array leaves the text as it is."""
    chunks, ends, starts = unused(df, "_chunks", "_ends", "_starts")
    df = df.withColumn(chunks, _chunked(F.col(spans)))
    df = df.withColumn(ends, F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: F.greatest(a, x["e"]))))
    df = df.withColumn(starts, _before_each(ends, lambda a, x: F.greatest(a, x)))
    t = F.col(text)

    def part(c: Column, j: Column) -> Column:
        first, last = F.get(starts, j), F.get(starts, j + 1)
        zero = F.struct(
            first.alias("pos"), F.array().cast("array<string>").alias("out"), F.substring(t, first + 1, last - first).alias("part")
        )

        def step(a: Column, x: Column) -> Column:
            s, e = F.greatest(a["pos"], x["s"]), F.greatest(a["pos"], x["e"])
            more = F.array(F.substring(a["part"], a["pos"] - first + 1, s - a["pos"]), instead(s, e, x))
            return F.struct(e.alias("pos"), F.concat(a["out"], more).alias("out"), a["part"].alias("part"))

        return F.aggregate(c, zero, step, lambda a: F.array_join(a["out"], ""))

    done = F.concat(F.array_join(F.transform(chunks, part), ""), F.substring(t, F.element_at(starts, -1) + 1, F.length(t)))
    return df.withColumn(out, F.when(F.size(chunks) > 0, done).otherwise(t)).drop(chunks, ends, starts)


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a column of valid strict matches for each kind."""
    digit = unused(df, "_digit")[0]
    df = df.withColumn(digit, F.col(text).rlike("[0-9]"))
    for rank, kind in enumerate(KINDS):
        if kind == "email":
            hint = F.contains(F.col(text), F.lit("@"))
        else:
            hint = F.col(digit) & F.col(text).rlike(HINTS[kind])
        df = _located(df, text, PATTERNS[kind], hint, rank, kind)
        df = df.withColumn(kind, _only_valid(kind))
    return df.drop(digit)


def _candidates(df: DataFrame, text: str, out: str) -> DataFrame:
    """Identifier-like tokens outside the valid strict matches, which are
    blanked out at the same length first; a match that isn't valid stays."""
    masked, strict = unused(df, "_masked", "_strict")
    some = reduce(lambda a, b: a | b, [F.size(k) > 0 for k in KINDS])
    spans = F.sort_array(F.concat(*[F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS]))
    df = df.withColumn(strict, F.when(some, spans))
    df = _replaced(df, text, strict, lambda s, e, x: F.repeat(F.lit("\x01"), e - s), masked).drop(strict)
    hint = F.col(masked).rlike("[0-9@]")
    df = _located(df, masked, CANDIDATE, hint, -1, out).drop(masked)
    core = lambda x: F.regexp_replace(x["m"], "[._%+/-]+$", "")
    trimmed = F.transform(
        out,
        lambda x: F.struct(
            x["s"].alias("s"), x["k"].alias("k"), (x["s"] + F.length(core(x))).alias("e"), core(x).alias("m"),
            x["before"].alias("before"), x["after"].alias("after"),
        ),
    )
    return df.withColumn(out, F.filter(trimmed, lambda x: F.length(x["m"]) >= 5))


def _plain(words: Column) -> Column:
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def _occurrences(found: DataFrame) -> DataFrame:
    """A row for each seed and candidate: key, kind (null: candidate),
    instance, offsets, the two words before it and the one after."""
    every = F.concat(*[F.col(k) for k in KINDS], F.col("cand"))
    x = found.select("key", F.explode(every).alias("x"))
    before = F.filter(F.split(_plain(F.col("x.before")), r"[\x20\x09-\x0D\x01]+"), lambda w: w != "")
    after = F.filter(F.split(_plain(F.col("x.after")), r"[\x20\x09-\x0D\x01]+"), lambda w: w != "")
    return x.select(
        "key", F.when(F.col("x.k") >= 0, F.col("x.k")).alias("kind"),
        F.xxhash64(F.regexp_replace(F.lower("x.m"), r"[\x20().-]", "")).alias("inst"),
        F.lower("x.m").alias("m"), F.col("x.s").alias("s"), F.col("x.e").alias("e"),
        F.get(before, F.size(before) - 2).alias("l2"), F.get(before, F.size(before) - 1).alias("l1"),
        F.get(after, F.lit(0)).alias("r1"),
    )


def _patterned(occ: DataFrame) -> DataFrame:
    """Occurrences by lexical pattern, with the pattern's anchor word."""
    none = F.lit("")
    pats = F.array(
        F.struct(F.xxhash64(F.lit("l"), "l1").alias("pattern"), F.col("l1").alias("anchor")),
        F.struct(F.xxhash64(F.lit("ll"), "l2", "l1").alias("pattern"), F.col("l1").alias("anchor")),
        F.struct(F.xxhash64(F.lit("lr"), "l1", "r1").alias("pattern"), F.col("l1").alias("anchor")),
        F.struct(F.xxhash64(F.lit("r"), "r1").alias("pattern"), F.concat(F.lit(">"), F.col("r1")).alias("anchor")),
    )
    return (
        occ.select("kind", "inst", F.explode(pats).alias("p")).select("kind", "inst", "p.pattern", "p.anchor")
        .where(F.coalesce("anchor", none).rlike(r"\p{L}{2}"))
    )


def discover(docs: DataFrame, occ: DataFrame, text: str) -> DataFrame:
    """Candidates (inst, m, kind) that high-confidence patterns discover."""
    by = _patterned(occ)
    edges = by.groupBy("pattern", "inst").agg(F.min("kind").alias("kind"), F.first("anchor").alias("anchor"))
    enough = F.greatest(*[F.count(F.when(F.col("kind") == k, 1)) for k in range(len(KINDS))]) >= MIN_SEEDS
    # all a pattern's rows have the one anchor
    supported = edges.groupBy("pattern").agg(F.first("anchor").alias("anchor"), enough.alias("ok")).where("ok")
    # how often the anchors stand beside a seed, against how often they stand at all
    beside = (
        occ.where("kind is not null")
        .select(F.explode(F.array("l1", F.concat(F.lit(">"), F.col("r1")))).alias("anchor"))
        .where("anchor is not null").groupBy("anchor").agg(F.count(F.lit(1)).alias("beside"))
    )
    anchors = supported.select("anchor").distinct().join(beside, "anchor").select(
        "anchor", "beside", F.regexp_replace("anchor", "^>", "").alias("word")
    )
    words = (
        docs.select(F.explode(F.split(_plain(no_text(text)), r"[\x20\x09-\x0D]+")).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    sure = (
        anchors.join(words, "word", "left")
        .where(F.col("beside") >= MIN_ANCHOR_SHARE * F.greatest(F.coalesce("n", F.lit(0)), F.col("beside")))
        .select("anchor")
    )
    patterns = supported.join(sure, "anchor", "left_semi").select("pattern")
    live = materialize(edges.join(patterns, "pattern", "left_semi").select("pattern", "inst", "kind"), "pii-edges")

    one_hot = [F.when(F.col("kind") == k, 1.0).otherwise(0.0).alias(f"s{k}") for k in range(len(KINDS))]
    sums = [f"s{k}" for k in range(len(KINDS))]
    scored = live.select("pattern", "inst", "kind", *one_hot)
    for _ in range(TURNS):
        conf = scored.groupBy("pattern").agg(*[F.avg(s).alias(s) for s in sums])
        noisy_or = [(F.lit(DAMPING) * (1 - F.exp(F.sum(F.log1p(-F.least(F.col(s), F.lit(1 - 1e-9))))))).alias(s) for s in sums]
        score = live.where("kind is null").join(conf, "pattern").groupBy("inst").agg(*noisy_or)
        late = score.select(F.col("inst").alias("i"), *[F.col(s).alias(f"n{s}") for s in sums])
        scored = live.select("pattern", "inst", "kind", *one_hot).join(late, F.col("inst") == F.col("i"), "left").select(
            "pattern", "inst", "kind", *[F.greatest(F.col(s), F.coalesce(F.col(f"n{s}"), F.lit(0.0))).alias(s) for s in sums]
        )
    best = F.array_max(F.array(*[F.struct(F.col(s).alias("v"), F.lit(-k).alias("k")) for k, s in enumerate(sums)]))
    return (
        scored.where("kind is null").select("inst", best.alias("b")).where(F.col("b.v") >= MIN_SCORE)
        .groupBy("inst").agg((-F.max("b.k")).alias("found"))
    )


def _fits(kind: Column, m: Column) -> Column:
    """A discovered token must look like its kind, loosely."""
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return F.when(kind == 0, F.contains(m, F.lit("@"))).otherwise(digits >= 4)


def find_pii(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans``: sorted arrays of
    (s, k, e) with k the index in ``KINDS``; ``with_text`` adds the text as
    ``body``."""
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], no_text(text).alias("body"))
    keyed = rows.withColumn("key", wide_key(*[x for n in names for x in (F.col(n).isNull(), F.col(n).cast("string"))], F.md5(F.col("body").cast("binary"))))
    based = base_spans(keyed, "body")
    found = _candidates(based, "body", "cand").select("key", *KINDS, "cand")
    occ = materialize(_occurrences(found), "pii-occurrences")
    accepted = discover(docs, occ, text)
    added = (
        occ.where("kind is null").join(accepted, "inst")
        .where(_fits(F.col("found"), F.col("m")))
        .groupBy("key").agg(F.collect_set(F.struct("s", F.col("found").alias("k"), "e")).alias("added"))
    )
    base = F.sort_array(F.concat(*[F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))) for k in KINDS]))
    narrow = based.select(*names, "key", base.alias("base"), *(["body"] if with_text else []))
    out = narrow.join(added, "key", "left")
    # candidates lie outside the base spans, which were blanked out
    spans = F.when(F.size("added") > 0, F.sort_array(F.concat("base", "added"))).otherwise(F.col("base"))
    return out.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)], "base", spans.alias("spans"), *(["body"] if with_text else [])
    )


def redacted(df: DataFrame, text: str, spans: str, out: str) -> DataFrame:
    """``df`` with ``out``: the text with each span, or union of overlapping
    spans, replaced by its first kind in brackets."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    return _replaced(df, text, spans, lambda s, e, x: F.when(x["s"] >= s, F.get(tags, x["k"])).otherwise(""), out)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; same columns.
    Null texts stay null; a count of characters is not the operator's to
    change, so other columns stay as they are."""
    others = [c for c in docs.columns if c != text]
    missing = unused(docs, "_missing")[0]
    found = find_pii(docs.withColumn(missing, F.col(text).isNull()), text, (*others, missing), with_text=True)
    spans, base, body, missing = unused(docs, "spans", "base", "body", "missing")
    # by position, whatever docs' own columns are called
    found = found.toDF(*others, missing, base, spans, body)
    clean = unused(found, "_clean")[0]
    found = redacted(found, body, spans, clean)
    return found.select(*[F.when(~F.col(missing), F.col(clean)).alias(c) if c == text else F.col(c) for c in docs.columns])
