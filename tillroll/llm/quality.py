"""Quality rules by cross-document line frequency, in DataFrame functions.

Base rules per document: word count and repeated three-word windows.  The
method: normalised lines are hashed, the distinct documents that hold a line
are counted within each host, lines above the limit are taken for
boilerplate and removed, and a document of which too little remains is
rejected.

Documents, not copies, are counted, in two steps.  First the distinct
normalised texts that hold a line are counted, so exact copies are one; a
line that stands in no more texts than the limit is settled.  The others would
deplete some documents.  Those are looked at again, as near copies deplete one
another: in the second count a *depleted* document is told apart by a sketch
instead of its text.  Its *own* lines are those that are neither above the
limit by the first count nor share one of their marks (the lowest and highest
hashes of their three-word windows) with such a line of a depleted document, as
a line of which a few words were changed does.  The sketch is the lowest and
the highest window of the own lines, each counted by itself and the larger
count taken.  So pages that share header, navigation and footer count one by
one as long as anything on them is their own, and a group of copies doesn't
turn its own prose into boilerplate (which of them stays is a matter for
de-duplication).  Documents with nothing of their own are told apart by the
sketch of all their lines: whether those are pages of nothing but boilerplate
or copies with lines left out can't be seen from lines.  Documents that keep
enough beside the lines above the limit count one by one in both steps; only
the depleted ones' windows are hashed.

Defined cases: a null text has no words (and fails the base rule); a null
host is a host of its own; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import content_key, materialize, no_text, unused, wide_key
from tillroll.sources.files import remove

CONTROL_SPACE = r"[\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Production parameters.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS_PER_HOST = 20
MIN_LEFT_PERCENT = 30

#: Hashes that a line is looked up by, half of them the lowest, half the highest.
MARKS = 4


def _words(text: Column) -> Column:
    # a split at one plain character needs no regular expression
    return F.filter(F.split(F.regexp_replace(text, CONTROL_SPACE, " "), " ", -1), lambda w: w != "")


def _repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Words inside 3-word windows that stand in the text twice or more.

    Windows are compared by 64-bit hash.  Most texts stop at the size of
    their distinct hashes; only those with a repeat sort (hash, position).
    """
    hashes, repeats = unused(df, "_hashes", "_repeats")
    w = F.col(words)
    df = df.withColumn(
        hashes,
        F.when(
            F.size(w) >= 4,
            F.transform(
                F.slice(w, 1, F.size(w) - 2),
                lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    h = F.col(hashes)
    df = df.withColumn(
        repeats,
        F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    r = F.col(repeats)
    again = F.filter(
        r,
        lambda x, i: ((i > 0) & (F.get(r, i - 1)["h"] == x["h"]))
        | F.coalesce(F.get(r, i + 1)["h"] == x["h"], F.lit(False)),
    )
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return df.withColumn(out, F.coalesce(F.size(covered), F.lit(0)).cast("long")).drop(hashes, repeats)


def text_measures(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep`` plus the five base counts and ``base_failed``."""
    df = docs.select(*keep, no_text(text).alias("_t")).withColumn("_w", _words(F.col("_t")))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines)
    df = _repeat_words(df, "_w", "n_repeat_words")
    df = df.select(
        *[c for c in df.columns if c not in ("_t", "_w", "_lines", "n_repeat_words")],
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    return df.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _normalised(text: str) -> Column:
    """The text's lines with a word, as (pos, x), normalised: lower case,
    digits as one 0, blanks as one."""
    # single blanks, which are most, aren't replaced by themselves
    blanks = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"
    norm = F.regexp_replace(F.regexp_replace(F.lower(no_text(text)), "[0-9]+", "0"), blanks, " ")
    lines = F.transform(F.split(norm, "\n", -1), lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("x")))
    return F.filter(lines, lambda x: x["x"] != "")


def _line_hash(x: Column) -> Column:
    return F.xxhash64(F.md5(x.cast("binary")))


def hashed_lines(docs: DataFrame, key: Column, text: str, host: str) -> DataFrame:
    """A row for each line with a word: the document's key, the host, the
    line's place and hash, its words, the words of all lines, and the hash of
    the document's whole normalised text."""
    df = docs.select(key.alias("key"), F.col(host).cast("string").alias("host"), _normalised(text).alias("lines"))
    words = lambda x: (F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1).cast("long")
    hashed = F.transform("lines", lambda x: F.struct(x["pos"].alias("pos"), _line_hash(x["x"]).alias("line"), words(x["x"]).alias("words")))
    df = df.select("key", "host", hashed.alias("lines"))
    # outer: the plain form infers a filter on the array, pushed down with all the work on the lines copied into it
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    rows = df.select("key", "host", F.xxhash64("lines.line").alias("body"), total.alias("total"), F.explode_outer("lines").alias("x"))
    return rows.where("x is not null").select("key", "host", "x.pos", "x.line", "x.words", "total", "body")


def marked_lines(docs: DataFrame, key: Column, text: str, host: str) -> DataFrame:
    """(key, host, pos, line, marks): the lines with their marks, sorted, for
    the few documents that need them."""

    def marks(x: Column) -> Column:
        w = F.split(x, " ", -1)
        three = F.transform(F.slice(w, 1, F.size(w) - 2), lambda a, i: F.concat_ws(" ", a, F.get(w, i + 1), F.get(w, i + 2)))
        hashes = F.sort_array(F.transform(F.when(F.size(w) >= 3, three).otherwise(F.array(x)), lambda g: F.md5(g.cast("binary"))))
        return F.when(F.size(hashes) > MARKS, F.concat(F.slice(hashes, 1, MARKS // 2), F.slice(hashes, -(MARKS // 2), MARKS // 2))).otherwise(hashes)

    df = docs.select(key.alias("key"), F.col(host).cast("string").alias("host"), F.explode_outer(_normalised(text)).alias("x")).where("x is not null")
    return df.select("key", "host", "x.pos", _line_hash(F.col("x.x")).alias("line"), marks(F.col("x.x")).alias("marks"))


def _counted(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Distinct values.  The first level groups by the value too, so a line
    that stands everywhere is spread by its holders; the second sees one row
    for each task and line after map-side sums."""
    return rows.groupBy(*by, value).agg(F.lit(1).alias("one")).groupBy(*by).agg(F.count("one").alias("docs"))


def _on(a: DataFrame, b: DataFrame, column: str) -> Column:
    return a.host.eqNullSafe(b.host) & (a[column] == b[column])


def sketches(docs: DataFrame, keyed: Column, text: str, host: str, depleted: DataFrame, many: DataFrame) -> DataFrame:
    """(key, low, high) of the documents in ``depleted``."""
    some = docs.withColumn("_of", keyed).join(depleted.select(F.col("key").alias("_depleted")).distinct(), F.col("_of") == F.col("_depleted"), "left_semi")
    # equal rows share a key, and lines agree in key and position
    theirs = materialize(marked_lines(some, F.col("_of"), text, host).dropDuplicates(["key", "pos"]), "marked")
    known = theirs.join(many, _on(theirs, many, "line"), "left_semi").select("host", F.explode("marks").alias("mark"))
    known = materialize(known.distinct(), "known")
    rest = theirs.join(many, _on(theirs, many, "line"), "left_anti")
    marked = rest.select("key", "pos", "host", F.explode("marks").alias("mark"))
    alike = marked.join(known, _on(marked, known, "mark"), "left_semi").select("key", "pos").distinct()
    own = rest.join(alike, ["key", "pos"], "left_anti")
    low, high = F.array_min("marks"), F.array_max("marks")
    sketch = lambda rows, a, b: rows.groupBy("key").agg(F.min(low).alias(a), F.max(high).alias(b))
    told = sketch(theirs, "low", "high").join(sketch(own, "own_low", "own_high"), "key", "left")
    return told.select("key", F.coalesce("own_low", "low").alias("low"), F.coalesce("own_high", "high").alias("high"))


def _common(
    docs: DataFrame, key: Column, text: str, host: str, max_docs: int, min_left_percent: int
) -> tuple[DataFrame, DataFrame]:
    """The (host, line) in more than ``max_docs`` distinct documents of a
    host, and the rows of all lines that the first count holds for such."""
    lines = materialize(hashed_lines(docs, key, text, host), "lines")
    many = materialize(_counted(lines, ["host", "line"], "body").where(F.col("docs") > max_docs).select("host", "line"), "many")
    above = materialize(lines.join(many, _on(lines, many, "line"), "left_semi"), "above")
    remove(lines)
    lost = above.groupBy("key", "pos").agg(F.max("words").alias("words"), F.max("total").alias("total"))
    lost = lost.groupBy("key").agg(F.sum("words").alias("words"), F.max("total").alias("total"))
    depleted = materialize(lost.where(100 * (F.col("total") - F.col("words")) < min_left_percent * F.col("total")).select("key"), "depleted")
    # only lines of depleted documents are counted again
    doubted = materialize(above.join(depleted, "key", "left_semi").select("host", "line").distinct(), "doubted")
    told = materialize(sketches(docs, key, text, host, depleted, many), "told")
    again = above.join(doubted, _on(above, doubted, "line"), "left_semi").join(told, "key", "left")
    body = F.col("body").cast("string")
    ways = F.array(*[F.struct(F.lit(i).alias("way"), F.coalesce(c, body).alias("other")) for i, c in enumerate(("low", "high"))])
    held = again.select("host", "line", F.explode(ways).alias("x")).select("host", "line", "x.way", "x.other")
    counted = _counted(held, ["host", "line", "way"], "other").groupBy("host", "line").agg(F.max("docs").alias("docs"))
    copies = counted.where(F.col("docs") <= max_docs)
    return materialize(many.join(copies, _on(many, copies, "line"), "left_anti"), "common"), above


def common_lines(
    docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = MAX_DOCS_PER_HOST, min_left_percent: int = MIN_LEFT_PERCENT
) -> DataFrame:
    """(host, line): hashes of the normalised lines that stand in more than
    ``max_docs`` distinct documents of a host."""
    return _common(docs, wide_key(F.col(host), F.md5(no_text(text).cast("binary"))), text, host, max_docs, min_left_percent)[0]


def quality(
    docs: DataFrame, text: str = "text", host: str = "source", keep: tuple[str, ...] = ("doc_id",),
    max_docs: int = MAX_DOCS_PER_HOST, min_left_percent: int = MIN_LEFT_PERCENT, places: str | None = None,
) -> DataFrame:
    """One row for each document: ``keep``, the base counts, ``base_failed``,
    ``n_common_words`` (words in removed lines) and ``kept``; ``places`` names
    a column for the numbers of the removed lines (null: none)."""
    row = F.struct(*[F.col(c) for c in keep], F.col(host), F.md5(no_text(text).cast("binary")))
    key = wide_key(row)
    common, above = _common(docs, key, text, host, max_docs, min_left_percent)
    # repeated rows agree in key and position, so each line counts once
    lost = (
        above.join(common, _on(above, common, "line"), "left_semi")
        .groupBy("key", "pos").agg(F.max("words").alias("words"))
        .groupBy("key").agg(F.sum("words").alias("n_common_words"), *([F.sort_array(F.collect_list("pos")).alias("_places")] if places else []))
    )
    names = [f"_k{i}" for i in range(len(keep))]  # whatever the kept columns are called
    measured = text_measures(docs, text, [*[F.col(c).alias(n) for c, n in zip(keep, names)], key.alias("key")])
    # written: a caller's filter on the verdict would else be pushed down into
    # the measures, with their expressions copied into one another
    out = materialize(measured, "measures").join(lost, "key", "left").withColumn(
        "n_common_words", F.coalesce("n_common_words", F.lit(0).cast("long"))
    )
    left = F.col("n_words") - F.col("n_common_words")
    return out.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words",
        (~F.col("base_failed") & (100 * left >= min_left_percent * F.col("n_words"))).alias("kept"),
        *([F.col("_places").alias(places)] if places else []),
    )


def good(docs: DataFrame, text: str = "text", host: str | None = "source") -> DataFrame:
    """The kept documents, their common lines taken out of ``text``; same
    columns.  ``host`` None: each document is a host of its own.  Texts
    without a common line stay as they are, to the byte."""
    key, kept, places = unused(docs, "_key", "_kept", "_places")
    keyed = docs.withColumn(key, content_key(docs))
    verdict = quality(keyed, text, host or key, (key,), places="removed").where("kept").select(F.col(key).alias(kept), F.col("removed").alias(places))
    # equal rows share a key and a verdict
    whole = keyed.join(verdict.groupBy(kept).agg(F.first(places).alias(places)), F.col(key) == F.col(kept))
    lines = F.split(F.col(text), "\n", -1)
    rest = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places)), lambda i: F.get(lines, i))
    less = F.when(F.col(places).isNull(), F.col(text)).otherwise(F.array_join(rest, "\n"))
    return whole.select(*[less.alias(c) if c == text else F.col(c) for c in docs.columns])
