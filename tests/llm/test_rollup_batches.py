"""Batches of any name, rows counted once, copies with null and repeated ids."""

from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries as Q
from tillroll.llm import bpe, rollup
from tillroll.sources.files import fresh_path

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in store.totals().collect()}


def test_batches_of_any_name(spark):
    store = rollup.Rollup(spark, fresh_path(spark, "r"), {"v1": BPE})
    feed = spark.createDataFrame([("a", "en", "one two")], "source string, lang string, text string")
    names = ["__HIVE_DEFAULT_PARTITION__", "a/b", "a%2Fb", "..", "1", "01", "~2F", "é=x"]
    for n in names:
        assert store.commit(n, rollup.signed(feed, 1)) and store.committed(n) and not store.commit(n, rollup.signed(feed, 1))
    assert totals(store)["a", "en", "v1"][0] == len(names)
    with pytest.raises(ValueError):
        store.commit("", rollup.signed(feed, 1))


def test_counted_rows_give_the_same_deltas(spark):
    rows = [("a", "en", "one two", 1), ("a", None, None, 2), (None, "fr", "un deux trois", 3), ("a", "en", "", 4), ("a", "en", "one two", 1)]
    df = spark.createDataFrame(rows, "source string, lang string, text string, Tokens int")
    versions = {"v1": BPE, "v2": BPE}
    counted = rollup.counted(df, versions)
    assert counted.columns == ["source", "lang", "tokens"]
    look = lambda d: {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in d.collect()}
    for sign in (1, -1):
        assert look(rollup.deltas(rollup.signed_counts(counted, sign), versions)) == look(rollup.deltas(rollup.signed(df, sign), versions))
    assert rollup.counted(df.limit(0), versions).count() == 0
    # a recount under a new version takes the old numbers back
    store = rollup.Rollup(spark, fresh_path(spark, "r"), versions)
    store.commit("load", rollup.signed_counts(counted, 1))
    doubled = counted.withColumn("tokens", F.transform("tokens", lambda n: 2 * n))
    store.commit("recount", rollup.revised(counted, doubled, rollup.signed_counts))
    assert look(store.totals()) == {k: (d, 2 * n) for k, (d, n) in look(rollup.deltas(rollup.signed(df, 1), versions)).items()}


def test_query_on_null_and_repeated_ids(spark, tmp_path):
    rows = [(3, "b", "en", "x y"), (1, "a", "en", "x y"), (1, "a", "en", "x y"), (None, "a", "en", "x y"), (None, "n", None, "only"), (5, None, None, None), (6, "a", "fr", "")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    enc, want, first = bpe.Encoder(BPE), defaultdict(lambda: [0, 0]), {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(r[3] or "", r)
    for i, s, g, t in first.values():
        want[s, g][0] += 1
        want[s, g][1] += len(enc.encode([t or ""])[0]) // 2
    got = {(r.source, r.lang): [r.docs, r.tokens] for r in Q.op8_token_rollup(spark, str(tmp_path)).collect()}
    assert got == dict(want)
