"""The registered queries of the operators, and DuckDB SQL where it can say
the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import chat, decontaminate, periodic, pii, quality, rollup, secrets, sharding, simhash, token_files, topk, trie, unigram
from tillroll.llm.tables import documents, materialize, table
from tillroll.sources.files import fresh_path

SHARDS = 40


def vocabulary(name: str) -> str:
    """A public tokenizer file's place on this machine (and, by the same
    package, on each executor)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _joined(spans, kinds) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"], x["e"])), ",")


def _count(spans: str, k: int):
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *[_count("base", k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(_joined("base", pii.KINDS), 256).alias("base_sha256"),
        _joined("spans", pii.KINDS).alias("spans"),
    )


def op2_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op4_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[_count("secret_base", k).alias(f"n_{kind}") for k, kind in enumerate(secrets.BASE_KINDS)],
        F.sha2(_joined("secret_base", secrets.KINDS), 256).alias("base_sha256"),
        _joined("secret_spans", secrets.KINDS).alias("spans"),
    )


def op5_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(documents(spark, sf_dir), items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_files.read_digests(spark, path)


def op7_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids and compares: pieces, CRC-32 of
    the ids (comma-joined) and of the decoded text, and whether it's the
    text."""
    model = unigram.load(spark, vocabulary("piece_bpe_32k.model"))
    back = unigram.round_trip(documents(spark, sf_dir).select("doc_id", "text"), model)
    return back.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
        F.crc32(F.array_join("piece_ids", ",").cast("binary")).alias("ids_crc32"), "decoded_crc32", "exact",
    )


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits: all documents are inserted without their
    sources, the same batch comes a second time, a revision of every row
    gives them their sources, and copies are deleted: of a text's rows the
    one with the smallest id stays (a null id is the largest; then the
    smallest source and language).  Texts are tokenised once."""
    vocabularies = {"byte_bpe_50k": vocabulary("byte_bpe_50k.json")}
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    rows = materialize(rollup.counted(docs, vocabularies), "counted")
    store = rollup.Rollup(spark, fresh_path(spark, "rollup"), vocabularies)
    early = rows.withColumn("source", F.lit(None).cast("string"))
    store.commit("load", rollup.signed_counts(early, 1))
    store.commit("load", rollup.signed_counts(early, 1))
    store.commit("sources", rollup.revised(early, rows, rollup.signed_counts))
    # all go and the first ones come back; a text that stands once cancels out
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "source", "lang", "tokens")).alias("x")
    first = rows.groupBy("key").agg(least).select("x.source", "x.lang", "x.tokens")
    store.commit("copies", rollup.revised(rows, first, rollup.signed_counts))
    return store.totals()


def op9_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.sharded(documents(spark, sf_dir).select("doc_id", "text"), SHARDS)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string",
    )
    formatted = materialize(chat.segments(turns.unionByName(probe)), "segments")
    targets = materialize(chat.examples(formatted), "examples")
    return chat.digests(formatted, targets)


def op11_sequence_collapse_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents (by the CRC-32 h of the
    id), the words from number g mod n on repeat with a period, g = h div 10.
    A document without an id keeps its words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.regexp_replace("text", periodic.BLANKS, " "), " ", -1), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    rows = rows.select("doc_id", "text", "w", F.when(n > 0, a).alias("a"), F.when(n > 0, p).alias("p"))
    moved = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(moved, " ")).alias("text"))


def op12_minimizer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.with_runs(with_planted_periods(documents(spark, sf_dir)))
    best = periodic.strongest("runs")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    all_runs = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(all_runs.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_contextual_pii, op2_covering_simhash, op3_line_frequency_quality, op4_structural_secrets,
        op5_prefix_decontamination, op6_rans_token_files, op7_unigram_pieces, op8_token_rollup,
        op9_differencing_shards, op10_prefix_target_chat, op11_sequence_collapse_trie, op12_minimizer_runs, op13_histogram_topk,
    )
    return {f.__name__: f for f in ops}


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
grams AS (SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
base AS (
  SELECT w.rid, doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)),
line AS (SELECT rid, host, x, pos, len(string_split(x, ' ')) AS words FROM (SELECT rid, host, trim(unnest(l)) AS x, unnest(range(len(l))) AS pos
  FROM (SELECT rid, host, string_split(regexp_replace(regexp_replace(lower(t), '[0-9]+', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)) AS l FROM d)) WHERE x <> ''),
body AS (SELECT rid, md5(string_agg(x, chr(10) ORDER BY pos)) AS body, sum(words) AS total FROM line GROUP BY rid),
first AS (SELECT host, x FROM line JOIN body USING (rid) GROUP BY host, x HAVING count(DISTINCT body) > 20),
above AS (SELECT line.* FROM line JOIN first ON line.x = first.x AND line.host IS NOT DISTINCT FROM first.host),
depleted AS (SELECT rid FROM above JOIN body USING (rid) GROUP BY rid, total HAVING 100 * (total - sum(words)) < 30 * total),
grams3 AS (SELECT rid, host, x, pos, list_sort(list_transform(CASE WHEN words >= 3 THEN list_transform(range(1, words - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) ELSE [x] END, lambda g: md5(g))) AS h
  FROM (SELECT line.*, string_split(x, ' ') AS w FROM line JOIN depleted USING (rid))),
marked AS (SELECT rid, host, x, pos, CASE WHEN len(h) > 4 THEN [h[1], h[2], h[-2], h[-1]] ELSE h END AS marks FROM grams3),
known AS (SELECT DISTINCT marked.host, unnest(marks) AS mark FROM marked JOIN first ON marked.x = first.x AND marked.host IS NOT DISTINCT FROM first.host),
rest AS (SELECT marked.* FROM marked ANTI JOIN first ON marked.x = first.x AND marked.host IS NOT DISTINCT FROM first.host),
alike AS (SELECT DISTINCT rid, pos FROM (SELECT rid, pos, host, unnest(marks) AS mark FROM rest) r JOIN known ON r.mark = known.mark AND r.host IS NOT DISTINCT FROM known.host),
own AS (SELECT rest.* FROM rest ANTI JOIN alike ON rest.rid = alike.rid AND rest.pos = alike.pos),
told AS (SELECT a.rid, coalesce(b.low, a.low) AS low, coalesce(b.high, a.high) AS high
  FROM (SELECT rid, min(list_min(marks)) AS low, max(list_max(marks)) AS high FROM marked GROUP BY rid) a
  LEFT JOIN (SELECT rid, min(list_min(marks)) AS low, max(list_max(marks)) AS high FROM own GROUP BY rid) b USING (rid)),
many AS (SELECT host, x FROM above JOIN body USING (rid) LEFT JOIN told USING (rid) GROUP BY host, x
  HAVING greatest(count(DISTINCT coalesce(low, body)), count(DISTINCT coalesce(high, body))) > 20),
lost AS (SELECT rid, sum(len(string_split(line.x, ' '))) AS n FROM line JOIN many
  ON line.x = many.x AND line.host IS NOT DISTINCT FROM many.host GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(lost.n, 0)::BIGINT AS n_common_words,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - coalesce(lost.n, 0)) >= 30 * n_words AS kept
FROM base LEFT JOIN lost USING (rid)
"""

OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT rid, grams.i, grams.n, item FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
control AS (SELECT '<</?SYS>>|\[/?INST\]|</?s>|\[/?ROLE\]|\[/TURN\]' AS c),
e AS (
  SELECT t.*, length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, c)) AS chars,
    CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 20 + length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, c)) END AS marks
  FROM t, control)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + marks)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


# CRC-32 of a number's digits: each is put in, then eight shifts follow.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id AS c, conv_id - conv_id % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT,
    flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: [1000 + ascii(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: CASE WHEN x >= 1000 THEN xor(a, x - 1000) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) & 3 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c, 0 AS part, pos, role, text FROM ids JOIN t ON conv_id = b AND pos <= h
  UNION ALL SELECT c, 1, pos, role, text FROM ids JOIN t ON conv_id = c AND pos > h),
s AS (SELECT ids.c, coalesce(list(struct_pack(role := role, text := text) ORDER BY part, pos) FILTER (pos IS NOT NULL), []) AS l
  FROM ids LEFT JOIN r USING (c) GROUP BY ids.c),
p AS (SELECT c, d, l[1:d] AS k, l FROM (SELECT *, unnest(range(len(l) + 1)) AS d FROM s)),
n AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(l) = d) AS ends,
    (count(*) - 1) * CASE d WHEN 0 THEN 0 ELSE len(regexp_extract_all(k[d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM p GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
full_n AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, k)),
up AS (SELECT a AS d, k[1:a] AS k, saved, n_children FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_n)),
below AS (SELECT d, k, sum(saved)::BIGINT AS saved_tokens, (count(*) FILTER (n_children = 0))::BIGINT AS n_leaves FROM up GROUP BY d, k)
SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM full_n x JOIN below USING (d, k) LEFT JOIN n y ON y.d = x.d - 1 AND y.k = x.k[1:x.d - 1]
"""

OP13_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_frequency_quality": OP3_SQL, "op5_prefix_decontamination": OP5_SQL, "op10_prefix_target_chat": OP10_SQL,
        "op11_sequence_collapse_trie": OP11_SQL, "op13_histogram_topk": OP13_SQL,
    }
