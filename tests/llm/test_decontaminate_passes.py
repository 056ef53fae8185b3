"""A benchmark of any size reads the documents twice."""

import random

from tests.fixtures import plan_text

from tillroll.llm import decontaminate


def test_a_large_benchmark_reads_the_documents_twice(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdef", k=3))
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 40)))) for i in range(300)]
    docs = [(i, " ".join(word() for _ in range(80)) + (" " + items[i % 300][1] if i % 3 == 0 else "")) for i in range(200)] + [(7, items[7][1]), (7, items[7][1])]
    at = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(at)
    d, b = spark.read.parquet(at), spark.createDataFrame(items, "item_id long, text string")
    plans, keep = [], decontaminate.materialize

    def seen(df, name, **kw):
        plans.append(plan_text(df))
        return keep(df, name, **kw)

    monkeypatch.setattr(decontaminate, "materialize", seen)
    got = decontaminate.contamination(d, b, block_bytes=2000)  # the windows are dozens of times that
    plans.append(plan_text(got))
    assert sum(p.split("===== Subqueries")[0].count(f"Location: InMemoryFileIndex [file:{at}]") for p in plans) == 2
    rows = lambda df: sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect())
    assert rows(got) == rows(decontaminate.contamination(d, b)) and sum(r.n_hit > 0 for r in got.collect()) > 60


def test_common_prefix_words(spark):
    """Windows of one word over and over, which is everywhere."""
    items = [(1, "the " * 12), (2, "of the of the"), (3, "rare the the")]
    docs = [(i, "the " * (3 * i) + "of the of the x") for i in range(12)] + [(99, "a rare the the")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = lambda df: sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect())
    assert rows(decontaminate.contamination(d, b, block_bytes=1)) == rows(decontaminate.contamination(d, b))
