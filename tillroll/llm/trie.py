"""A prefix trie of conversations by whole-sequence collapse.

Conversations may be rebuilt from the head of another one and their own rest
(``rebuilt``).  ``trie`` takes the conversations as rows (conversation, depth,
key of the first ``depth`` turns) and

* groups identical whole sequences into one weighted sequence each, with the
  list of the conversations that end there;
* drops the sequences that are a proper prefix of another one, by an anti-join
  with the proper prefixes, which leaves the leaves;
* sums the weighted prefixes of the distinct sequences, a node for each.

Keys are two 61-bit polynomials in the turns' digests, so those of a
conversation's pieces can be put together: rows are dealt by ranges of
(conversation, turn), tasks fold what they hold while it streams by, and a
row or two for each task say what came before -- a conversation that holds
most rows is spread over many tasks.  For the same reason a rebuilt
conversation's keys follow from those of its two sources, and texts are read
once and never shuffled.

Values summed over a node's subtree are linear in the nodes, too.  A node
belongs to the sequence of its smallest conversation, so a sequence's own
nodes are all from some depth on; the sum over a subtree is that of the own
nodes of all sequences that pass through its top, less the own nodes above it
-- a running sum along the sequence.

A node with a large share of all children (at most 1000 have a thousandth of
the nodes each) is joined to them by broadcast, all others by their key.

Defined cases: rows without a conversation's id belong to none; null roles and
texts are empty; turns go by number, null first, and turns of the same number
by digest; repeated rows are repeated turns; a conversation may lose all its
turns and then ends at the root; ids count as longs, others are an error; an
empty table gives no nodes, not even a root.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import materialize, no_text, numbered
from tillroll.sources.files import remove

PRIME = 2**61 - 1
#: Bases of the two polynomials; arbitrary.
BASES = (1_000_003_579_246_801_357, 1_777_771_234_567_890_123)

#: A conversation's head comes from the conversation at the start of its family.
FAMILY, LONGEST_HEAD = 20, 3
#: Ids listed in a piece of an end list: a power of two by this exponent.
PIECE_BITS = 12
#: A node is hot if more than this part of all nodes are its children.
HOT_PART = 1000

KEY = ["depth", "k1", "k2"]
SCAN = "conv long, pos long, words long, h1 long, h2 long, g1 long, g2 long, part int, total boolean"


def _times(a: Column, b: Column) -> Column:
    wide = "decimal(19,0)"
    return F.when(b == 1, a).otherwise((a.cast(wide) * b.cast(wide) % F.lit(PRIME).cast(wide)).cast("long"))


def prefix_keys(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, words, h1, h2, g1, g2): every turn's place in its
    conversation from 1, the words of its text, and the keys of the
    conversation up to and before it."""
    r, t = no_text(role), no_text(text)
    digest = F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), part(1).alias("x1"), part(16).alias("x2"),
        F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("x1"), F.col("x2")]
    names = [f.split()[0] for f in SCAN.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[f.split()[1]] for f in SCAN.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        r1, r2 = BASES
        at, n, h1, h2, p1, p2, convs = None, 0, 0, 0, 1, 1, 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            out = []
            for conv, x1, x2, words in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "x1", "x2", "words"))):
                if conv != at:
                    if convs == 1:  # may go on from an earlier task
                        out.append((at, n, 0, h1, h2, 0, 0, task, True))
                    at, n, h1, h2, p1, p2, convs = conv, 0, 0, 0, 1, 1, convs + 1
                g1, g2 = h1, h2
                n, p1, p2 = n + 1, p1 * r1 % PRIME, p2 * r2 % PRIME
                h1, h2 = (h1 + x1 * p1) % PRIME, (h2 + x2 * p2) % PRIME
                out.append((conv, n, words, h1, h2, g1, g2, task, False))
            if out:
                yield batch_of(out)
        if at is not None:
            yield batch_of([(at, n, 0, h1, h2, 0, 0, task, True)])

    local = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(scan, SCAN), "prefixes")
    # two rows for each task at most
    parts = defaultdict(list)
    for x in local.where("total").select("conv", "part", "pos", "h1", "h2").collect():
        parts[x.conv].append((x.part, x.pos, x.h1, x.h2))
    offsets = []
    for conv, pieces in parts.items():
        n, so_far = 0, (0, 0)
        for task, size, *own in sorted(pieces):
            powers = [pow(b, n, PRIME) for b in BASES]
            if n:
                offsets.append((conv, task, n, *so_far, *powers))
            so_far = tuple((s + p * h) % PRIME for s, p, h in zip(so_far, powers, own))
            n += size
    before = local.sparkSession.createDataFrame(offsets, "conv long, part int, n long, o1 long, o2 long, p1 long, p2 long")
    joined = local.where("not total").join(F.broadcast(before), ["conv", "part"], "left")

    def moved(lane: int, name: str) -> Column:
        own = F.col(f"{name}{lane}")
        return F.when(F.col("n").isNull(), own).otherwise((F.col(f"o{lane}") + _times(own, F.col(f"p{lane}"))) % PRIME).alias(f"{name}{lane}")

    return joined.select("conv", (F.col("pos") + F.coalesce("n", F.lit(0))).alias("pos"), "words", *[moved(i, x) for x in "hg" for i in (1, 2)])


def rebuilt(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, words): every conversation c made of the
    first h turns of conversation c - c % 20 and its own after its first h,
    with h = crc32(c) % 4; a row with depth 0 for each conversation, and one
    for each turn, with the keys up to and before it."""
    rows = prefix_keys(turns, **columns)
    h = lambda c: (F.crc32(F.col(c).cast("string").cast("binary")) % (LONGEST_HEAD + 1)).cast("int")
    first = materialize(
        rows.where(F.col("pos") <= LONGEST_HEAD).groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "words", "h1", "h2", "g1", "g2"))).alias("own")),
        "heads",
    )
    bases = first.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("base"), F.col("own").alias("lent"))
    heads = first.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(bases, "base", "left").withColumn("h", h("conv"))
    heads = heads.withColumn("lent", F.coalesce("lent", F.slice("own", 1, 0)))
    heads = heads.withColumn("m", F.least("h", F.size("lent"))).withColumn("lent", F.slice("lent", 1, F.col("m")))
    key_at = lambda a, n, name: F.coalesce(F.get(a, n - 1)[name], F.lit(0))
    for lane, base in enumerate(BASES, 1):
        shorter = F.array(*[F.lit(pow(base, -i, PRIME)) for i in range(LONGEST_HEAD + 1)])
        f = F.get(shorter, F.col("h") - F.col("m"))
        offset = F.pmod(key_at("lent", F.col("m"), f"h{lane}") - _times(key_at("own", F.col("h"), f"h{lane}"), f), F.lit(PRIME))
        heads = heads.withColumn(f"f{lane}", f).withColumn(f"o{lane}", offset)
    heads = materialize(heads.select("conv", "h", "m", "lent", "f1", "f2", "o1", "o2"), "rebuilding")
    rest = rows.where(F.col("pos") > h("conv")).join(heads.drop("lent"), "conv")
    moved = lambda name, lane, out: ((F.col(f"o{lane}") + _times(F.col(f"{name}{lane}"), F.col(f"f{lane}"))) % PRIME).alias(f"{out}{lane}")
    own = rest.select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), *[moved(x, i, y) for x, y in ("hk", "gp") for i in (1, 2)], "words")
    zero = F.lit(0).cast("long")
    lent = heads.select("conv", F.explode("lent").alias("x")).select("conv", "x.pos", "x.h1", "x.h2", "x.g1", "x.g2", "x.words")
    root = heads.select("conv", *[zero.alias(c) for c in (*KEY, "p1", "p2", "words")])
    return own.union(lent).union(root)


def end_lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids (ascending, joined by commas) of each key's
    conversations.  The ids are listed in pieces of 4096 at most; a task
    streams the pieces of a key one after another, however many there are."""
    pieces = ends.groupBy(*KEY, F.shiftright("conv", PIECE_BITS).alias("piece")).agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[*KEY, "ends_sha256"])

        at, state = None, None
        for b in batches:
            out = []
            for *key, ids in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in (*KEY, "ids"))):
                if key == at:
                    state.update(b"," + ids.encode())
                    continue
                if at:
                    out.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(ids.encode())
            if out:
                yield batch_of(out)
        if at:
            yield batch_of([(*at, state.hexdigest())])

    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``rows``, as ``rebuilt`` gives them:
    conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, of each node the
    words of its last turn for every member but one), ends_sha256."""
    rows = materialize(rows, "turns")
    ends = materialize(rows.groupBy("conv").agg(F.max(F.struct(*KEY)).alias("end")).select("conv", "end.*"), "ends")
    whole = materialize(ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("rep")), "sequences")
    ended = end_lists(ends)
    reps = whole.select(F.col("rep").alias("conv"), "weight", F.col("depth").alias("whole"))
    prefixes = materialize(rows.join(reps, "conv"), "weighted-prefixes")
    proper = prefixes.where("depth < whole").select(*KEY).distinct()
    leaves = whole.join(proper, KEY, "left_anti").select(F.col("rep").alias("conv"))
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"),
        *[F.max(c).alias(c) for c in ("p1", "p2", "words")],  # one value each
    )
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words")
    along = materialize(numbered(nodes, ["conv_id", "depth"], "above", per="conv_id", add="saved"), "nodes")
    zero = F.lit(0).cast("long")
    own = along.where("saved > 0").groupBy(F.col("conv_id").alias("conv")).agg(F.sum("saved").alias("saved"))
    of_sequence = own.select("conv", zero.alias("leaf"), "saved").union(leaves.select("conv", F.lit(1).cast("long"), zero))
    of_sequence = of_sequence.groupBy("conv").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved"))
    through = prefixes.select("conv", *KEY).join(of_sequence, "conv").select(*KEY, "n_leaves", "saved")
    # one aggregate by key brings together what is known of a node
    nothing = {"n_leaves": zero, "saved": zero, "n_children": zero, "ends_sha256": F.lit(None).cast("string"), "node": F.lit(None).cast("struct<conv_id:bigint,n_convs:bigint,above:bigint,p1:bigint,p2:bigint>")}
    known = [
        (through, {c: F.col(c) for c in ("n_leaves", "saved")}),
        (along.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")), {"n_children": F.lit(1).cast("long")}),
        (ended, {"ends_sha256": F.col("ends_sha256")}),
        (along, {"node": F.struct("conv_id", "n_convs", "above", "p1", "p2")}),
    ]
    parts = [df.select(*KEY, *[(has.get(c, x)).alias(c) for c, x in nothing.items()]) for df, has in known]
    whole_nodes = reduce(DataFrame.union, parts).groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("n_leaves", "saved", "n_children")], F.max("ends_sha256").alias("ends_sha256"), F.max("node").alias("node")
    )
    done = materialize(whole_nodes.select(*KEY, "n_leaves", "saved", "n_children", "ends_sha256", "node.*"), "trie")
    for t in (rows, ends, whole, prefixes, along):
        remove(t)
    return _with_parents(done)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """The result rows, each with its parent's smallest conversation."""
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    above, on = above.where("n_children > 0"), ["depth", "p1", "p2"]
    hot_size = nodes.count() / HOT_PART
    hot = above.where(F.col("n_children") > hot_size)  # HOT_PART rows at most
    rest = above.where(F.col("n_children") <= hot_size).drop("n_children")
    met = nodes.join(F.broadcast(hot.select(*on, F.col("parent_conv_id").alias("hot_parent"))), on, "left")
    settled = met.where("depth = 0 or hot_parent is not null").withColumn("parent_conv_id", F.col("hot_parent"))
    others = met.where("depth > 0 and hot_parent is null").join(rest, on)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return settled.unionByName(others).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("saved") - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
