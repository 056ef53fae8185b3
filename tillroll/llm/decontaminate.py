"""Benchmark decontamination as a prefix-filtered set join.

Query sets are the benchmark items' windows (``WINDOW`` consecutive words, a
shorter item whole).  A window is contained in a document only if all its
words are, so with the words ordered by rarity over the whole corpus a
prefix of one token -- the window's rarest word -- is necessary.  Documents
are probed with their occurrences of prefix words; an occurrence at p of a
word at offset j in a window can only mean a window from p - j (position)
that ends inside the text (length), and that is verified word by word.

The benchmark is the query set.  Up to ``BLOCK_BYTES`` of window text it is
broadcast and run against all documents.  A larger one is joined instead: the
texts are read once more, each occurrence of a prefix word (told by a Bloom
filter of fixed size) goes with the words around it to the windows of that
word, by an equi-join on the word, and is verified there.  However large the
benchmark, the documents are read a fixed number of times -- for the word
counts, for the probing, and if that was by broadcast once more for their own
columns -- and nothing that grows with the benchmark is held in a task.  Items are joined to
documents by Spark through classes of windows with the same items, so neither
a window in many items nor a document with many windows is expanded in pairs.

Defined cases: null texts have no words and no windows; a null item id
reads as an empty string; repeated rows give repeated results (repeated
items count once); empty tables on either side give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.tables import materialize, no_text, wide_key
from tillroll.operators.enrich import hot_lookup_join

WINDOW = 10
#: Bytes of window text that are broadcast at most; more are joined.
BLOCK_BYTES = 16 << 20
#: Bits of the Bloom filter of prefix words, a power of two.
FILTER_BITS = 1 << 26
#: Words whose place in the filter a worker remembers.
REMEMBERED = 200_000
#: Candidate windows verified at once.
CHUNK = 1 << 19

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that are no part of a word become blanks, A-Z become a-z.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def words_of(text: str):
    """The words as a column, without Python."""
    return F.filter(F.split(F.translate(no_text(text), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")


def windows_of(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(window, item) pairs: ``win`` (array of words) and ``item`` (string)."""
    w = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(text).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return (
        w.select("item", "w", F.explode(starts).alias("at"))
        .select(F.slice("w", F.col("at") + 1, F.lit(window)).alias("win"), "item").distinct()
    )


class _Block:
    """A block of windows as arrays: word ids, windows in order of their
    prefix word, offsets of that word, classes."""

    def __init__(self, rows, window: int):
        import numpy as np

        self.ids: dict[bytes, int] = {}
        number = lambda w: self.ids.setdefault(w.encode(), len(self.ids))
        rows = sorted(((number(r["word"]), r["at"], [number(x) for x in r["win"]], r["cls"]) for r in rows), key=lambda r: r[0])
        self.words = np.full((len(rows), window), -2, "int32")
        for i, r in enumerate(rows):
            self.words[i, : len(r[2])] = r[2]
        self.lens = np.array([len(r[2]) for r in rows], "int64")
        self.at = np.array([r[1] for r in rows], "int64")
        self.cls = np.array([r[3] for r in rows], "int64")
        prefix = np.array([r[0] for r in rows], "int64")
        n = np.bincount(prefix, minlength=len(self.ids) + 1)  # the last: words that aren't here
        self.start, self.count = np.cumsum(n) - n, n

    def find(self, ids):
        """(start, length) of each occurrence, and the classes, of a text."""
        import numpy as np

        found_s, found_n, classes = [], [], set()
        n = self.count[ids]
        pos = np.flatnonzero(n)
        total = np.cumsum(n[pos])
        at = 0
        while at < len(pos):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, "right")))
            p, k = pos[at:stop], n[pos[at:stop]]
            at = stop
            w = np.repeat(self.start[ids[p]] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            s = np.repeat(p, k) - self.at[w]
            ok = (s >= 0) & (s + self.lens[w] <= len(ids))  # position and length
            s, w = s[ok], w[ok]
            for j in range(self.words.shape[1]):  # verification
                want = self.words[w, j]
                ok = (want == -2) | (ids[np.minimum(s + j, len(ids) - 1)] == want)
                s, w = s[ok], w[ok]
            found_s.append(s)
            found_n.append(self.lens[w])
            classes.update(self.cls[w].tolist())
        if not classes:
            return [], []
        s, n = np.concatenate(found_s), np.concatenate(found_n)
        edge = np.zeros(len(ids) + 1, "int64")
        np.add.at(edge, s, 1)
        np.add.at(edge, s + n, -1)
        hit = np.diff(np.r_[0, np.cumsum(edge) > 0, 0].astype("int8"))
        return list(zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist())), sorted(classes)


def _probe(docs: DataFrame, block) -> DataFrame:
    """(key, n_words, runs, classes) of each document against one block."""
    schema = "key string, n_words long, runs array<struct<s:int,e:int>>, classes array<long>"
    runs_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import repeat

        import numpy as np

        b_ = block.value
        get, none = b_.ids.get, len(b_.ids)
        for b in batches:
            n_words, runs, classes = [], [], []
            for x in b.column(1):
                words = (x.as_py() or b"").translate(FOLD).split()
                ids = np.fromiter(map(get, words, repeat(none)), "int32", len(words))
                r, c = b_.find(ids) if words else ([], [])
                n_words.append(len(words))
                runs.append([{"s": s, "e": e} for s, e in r])
                classes.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(runs, runs_type), pa.array(classes, pa.list_(pa.int64()))],
                names=["key", "n_words", "runs", "classes"],
            )

    return docs.mapInArrow(work, schema)


def _prefixes(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """The windows with their rarest word (``word``) and its offset (``at``)."""
    words = hot_lookup_join(wins.select("win", "cls", F.posexplode("win").alias("at", "word")), counts, "word", "n")
    rare = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("x")
    return words.groupBy("win", "cls").agg(rare).select("win", "cls", "x.word", "x.at")


def _bloom(words: DataFrame):
    """Bits set at two places of each word's hash: FILTER_BITS in all."""
    import numpy as np

    h = F.xxhash64("word")
    places = words.select(F.explode(F.array(h.bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned(h, 32).bitwiseAND(FILTER_BITS - 1))).alias("bit"))
    place = F.col("bit") + 1  # Spark's buckets of 32768 begin at 1
    rows = places.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((FILTER_BITS // 32768, 4096), "uint8")
    for r in rows.collect():
        out[r["bucket"] - 1] = np.frombuffer(r["bits"], "uint8")
    return np.unpackbits(out.ravel(), bitorder="little").astype(bool)


def _joined_hits(rows: DataFrame, names: list[str], wins: DataFrame, corpus: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(names, key, n_words) of every document, and (key, s, e, cls) of its
    hits, for a benchmark of any size."""
    own = wins.select(F.explode("win").alias("word")).distinct()
    counts = corpus.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(own, "word", "left_semi")
    prefix = materialize(_prefixes(wins, materialize(counts, "word-counts")), "prefixes")
    bits = rows.sparkSession.sparkContext.broadcast(_bloom(prefix.select("word").distinct()))
    schema = T.StructType([
        *rows.select(*names, "key").schema.fields, T.StructField("n_words", T.LongType()), T.StructField("p", T.IntegerType()),
        T.StructField("c", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("around", T.ArrayType(T.StringType())),
    ])
    kept = [*names, "key"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        filled, seen = bits.value, {}

        def known(w: bytes) -> bool:
            x = seen.get(w)
            if x is None:
                h = xxhash.xxh64_intdigest(w, 42)
                if len(seen) >= REMEMBERED:
                    seen.clear()
                x = seen[w] = bool(filled[h & (FILTER_BITS - 1)] and filled[(h >> 32) & (FILTER_BITS - 1)])
            return x

        tail = pa.schema([("n_words", pa.int64()), ("p", pa.int32()), ("c", pa.int32()), ("word", pa.string()), ("around", pa.list_(pa.string()))])

        def out(b, which, cells):
            head = b.select(kept).take(pa.array(which, pa.int32()))
            columns = [pa.array(x, f.type) for x, f in zip(zip(*cells), tail)]
            return pa.RecordBatch.from_arrays([*head.columns, *columns], names=[*kept, *tail.names])

        for b in batches:
            body = b.column(b.schema.get_field_index("body"))
            which, cells = [], []
            for i in range(b.num_rows):
                words = (body[i].as_py() or b"").translate(FOLD).split()
                which.append(i)
                cells.append((len(words), -1, None, None, None))
                for p in np.flatnonzero(np.fromiter(map(known, words), bool, len(words))).tolist():
                    first = max(p - window + 1, 0)
                    which.append(i)
                    cells.append((None, p, p - first, words[p].decode("utf-8", "replace"), [w.decode("utf-8", "replace") for w in words[first : p + window]]))
                    if len(cells) >= 1 << 14:
                        yield out(b, which, cells)
                        which, cells = [], []
            if cells:
                yield out(b, which, cells)

    probed = materialize(rows.mapInArrow(work, schema), "probed")
    n = F.size("win")
    start = F.col("c") - F.col("at")
    inside = (start >= 0) & (start + n <= F.size("around"))  # position and length
    found = probed.where("p >= 0").select("key", "p", "c", "word", "around").join(prefix, "word").where(inside & (F.slice("around", F.greatest(start, F.lit(0)) + 1, n) == F.col("win")))
    hits = found.select("key", (F.col("p") - F.col("at")).alias("s"), (F.col("p") - F.col("at") + n).alias("e"), "cls")
    return probed.where("p < 0").select(*kept, "n_words"), hits


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` columns with n_words, n_hit (words inside an occurrence) and
    ``items`` (sorted array of the items that occur)."""
    spark = docs.sparkSession
    pairs = materialize(windows_of(items, item_id, item_text, window), "windows")
    # windows with the same items are a class: told apart by sums over the items' hashes
    h = F.xxhash64("item")
    sums = [F.count(F.lit(1)).cast("decimal(38,0)"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h).cast("decimal(38,0)")]
    wins = pairs.groupBy("win").agg(F.xxhash64(*sums).alias("cls"), F.min("item").alias("any"))
    wins = materialize(wins, "classes")
    rep = wins.groupBy("cls").agg(F.min("win").alias("win"))
    class_items = pairs.join(rep, "win").select("cls", "item")
    size = wins.agg(F.sum(F.octet_length(F.array_join("win", " ")))).first()[0] or 0

    names = [f"_k{i}" for i in range(len(keep))]
    values = [x for c in keep for x in (F.col(c).isNull(), F.col(c).cast("string"))]
    key = wide_key(*values, F.md5(no_text(text).cast("binary"))).alias("key")
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], key, F.col(text).cast("binary").alias("body"))
    corpus = docs.select(F.explode(words_of(text)).alias("word"))
    if size <= block_bytes:
        # rarity: each word's count over the whole corpus; the windows are a
        # broadcast's size, and so are their words, one row each, with the counts
        own = wins.select(F.explode("win").alias("word")).distinct()
        counts = corpus.join(F.broadcast(own), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        rare = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("x")
        prefix = (
            wins.select("win", "cls", F.posexplode("win").alias("at", "word")).join(F.broadcast(counts), "word", "left")
            .groupBy("win", "cls").agg(rare).select("win", "cls", "x.word", "x.at")
        )
        shared = spark.sparkContext.broadcast(_Block(prefix.toLocalIterator(), window))
        # sets: repeated rows, however many, add the same runs and classes
        per_key = _probe(rows.select("key", "body"), shared).groupBy("key").agg(
            F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_set("runs"))).alias("runs"),
            F.array_distinct(F.flatten(F.collect_set("classes"))).alias("classes"),
        )
        per_key = materialize(per_key, "per-document")
        every = rows.select(*names, "key").join(per_key.select("key", "n_words"), "key")
    else:
        every, hits = _joined_hits(rows, names, wins, corpus, window)
        per_key = materialize(
            hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("runs"), F.collect_set("cls").alias("classes")), "per-document"
        )
    found = (
        per_key.select("key", F.explode("classes").alias("cls")).join(class_items, "cls")
        .groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate(
        "runs", zero,
        lambda a, x: F.struct(
            F.greatest(a["end"], x["e"]).alias("end"),
            (a["n"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("n"),
        ),
        lambda a: a["n"],
    )
    return (
        every.join(per_key.select("key", union.alias("n_hit")), "key", "left").join(found, "key", "left")
        .select(
            *[F.col(n).alias(c) for c, n in zip(keep, names)], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark window occurs; same columns."""
    from tillroll.llm.tables import content_key, unused

    key = unused(docs, "_key")[0]
    keyed = docs.withColumn(key, content_key(docs))
    found = contamination(keyed, items, text, item_id, item_text, (key,), window).where("n_hit > 0")
    return keyed.join(found.select(key).distinct(), key, "left_anti").drop(key)
