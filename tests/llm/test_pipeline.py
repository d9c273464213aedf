"""The corpus pipeline: every stage's decisions take effect, and clean documents stay."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import decontaminate, language_id, simhash_dedup


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        docs = docs.checkpoint()
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay_until_the_last_stage(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run_gives_the_last_stage(spark, sf, stages):
    assert ids(corpus_pipeline.run(spark, sf)) == ids(stages[-1]) == ids(stages[-2])


def test_language_stage_keeps_documents_with_a_language(stages):
    assert len(ids(stages[1])) >= 0.99 * len(ids(stages[0]))
    assert not {r.lang_pred for r in language_id.identify(stages[1]).collect()} & {"und"}


@pytest.mark.parametrize("unlearned", ["en", "de"])
def test_language_stage_rejects_a_language_left_out_and_gibberish(spark, sf, unlearned):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("lang") != unlearned, F.col("lang")).otherwise(F.lit(None)))
    odd = docs.limit(1).withColumns({"doc_id": F.lit(10**9).cast("long"), "lang": F.lit(None).cast("string"), "text": F.lit("qzx vkj wqp the zzx kqj xvw jqz pqx vzk " * 5)})
    kept = corpus_pipeline.language(spark, docs.unionByName(odd), sf)
    assert kept.where("lang IS NULL").count() <= 0.01 * docs.where("lang IS NULL").count()
    assert kept.where("lang IS NOT NULL").count() >= 0.99 * docs.where("lang IS NOT NULL").count()


def test_quality_stage_keeps_good_labels(spark, sf, stages):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = lambda df: df.join(labels.where("quality = 1"), "doc_id").count()
    assert good(stages[2]) >= 0.97 * good(stages[1]) and len(ids(stages[2])) < len(ids(stages[1]))


def test_one_document_of_each_group_stays(stages):
    groups = simhash_dedup.similar_texts(stages[2]).select("component_id").distinct().count()
    assert len(ids(stages[3])) == groups
    again = simhash_dedup.similar_texts(stages[3])
    assert again.where("doc_id <> component_id").isEmpty()


def test_near_copies_of_a_document_go_and_others_stay(spark, sf):
    rng = np.random.default_rng(2)
    words = np.array([f"word{i}" for i in range(5000)])
    rows = []
    for i in range(60):
        text = rng.choice(words, 300)
        rows.append((10 * i, " ".join(text)))
        for k in range(1, 4):
            copy = text.copy()
            copy[rng.choice(300, k, replace=False)] = "changed"
            rows.append((10 * i + k, " ".join(copy)))
        half = text.copy()
        half[150:] = rng.choice(words, 150)
        rows.append((10 * i + 5, " ".join(half)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)})
    left = ids(corpus_pipeline.deduplicated(spark, docs, sf))
    assert {i for i in left if i % 10 in (0, 5)} == {i for i, _ in rows if i % 10 in (0, 5)}
    assert sum(i % 10 in (1, 2, 3) for i in left) <= 3


def test_stages_with_clashing_columns_long_texts_ties_and_repeated_rows(spark, sf):
    long = "the house on the hill is old and the garden is green in spring " * 30_000
    rows = [(1, long), (1, long), (2, long + "again"), (3, None), (3, None), (4, ""), (5, "a word"), (5, "a word"), (5, "another word"), (None, None)]
    names = ("row", "fp", "key", "node", "digest", "text_hash", "part", "u", "v", "n", "a", "b", "span", "count")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)} | {c: F.lit("x") for c in names})
    once = corpus_pipeline.deduplicated(spark, docs, sf)
    assert once.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in once.collect()) == sorted([(1, len(long)), (0, 0), (5, 6), (5, 12)])
    clean = corpus_pipeline.decontaminated(spark, docs, sf)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert corpus_pipeline.encoded(spark, docs, sf).count() == len(rows)


def test_contaminated_documents_go_and_others_stay(spark, sf, stages):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    hit = {r.doc_id for r in decontaminate.decontaminate(stages[3], items).where("n_hit > 0").collect()}
    assert ids(stages[4]) == [i for i in ids(stages[3]) if i not in hit]


def test_repeated_rows_null_texts_and_null_ids(spark, sf):
    text = "The house on the hill is old and the garden is green in spring."
    rows = [(1, text, "en"), (1, text, "en"), (1, "Der Hund und die Katze sind im Garten und spielen dort.", "de"), (2, None, "en"), (None, text, None), (3, "12 34", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.lit(1)})
    known = corpus_pipeline.language(spark, docs, sf)
    assert known.count() == 4
    once = corpus_pipeline.deduplicated(spark, known, sf)
    assert once.count() == 2
    assert corpus_pipeline.run_on(spark, docs.limit(0), sf).collect() == []


def test_columns_without_an_order_are_carried_along(spark):
    """Maps and arrays beside the documents' columns; of repeated rows one stays."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, {"a": 1}, [2]), (1, text, {"a": 2}, [1]), (2, text, None, None), (3, "something else that is said here only and only once", {"b": 3}, [3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, parts array<int>")
    left = corpus_pipeline.deduplicated(spark, docs, "").collect()
    assert sorted((r.doc_id, str(r.tags)) for r in left) == [(1, "{'a': 1}"), (3, "{'b': 3}")]
