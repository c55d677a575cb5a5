"""Each stage of the pipeline against a plain version on its own input."""

import inspect

import cases
import corpus_pipeline
import pytest
import test_decontamination
import test_packing
import test_simhash_dedup
import test_substring_dedup
from corpusloom.llm.decontamination import drop_contaminated
from corpusloom.llm.language_id import Classifier, fit, keep_identified
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.rows import text_key
from corpusloom.llm.simhash_dedup import drop_near_duplicates
from corpusloom.llm.substring_dedup import drop_repeated_sentences
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The input and output of every stage."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, FOLDER)
        done = spark.createDataFrame(done.collect(), done.schema)
        out[name] = (docs, done)
        docs = done
    return out


def _rows(df):
    return sorted((r.doc_id, r.text, r.lang) for r in df.collect())


def test_stages_are_whole(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "decontamination", "packing"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(done.columns == columns for name, (_, done) in steps.items() if name != "packing")
    # Where documents are cut follows the order of the rows; how many tokens each has, and what they fill, doesn't.
    tokens = lambda df: sorted((r.doc_id, r.doc_tokens, r.n) for r in df.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect())
    result, packed = corpus_pipeline.run(spark, FOLDER), steps["packing"][1]
    assert tokens(result) == tokens(packed)
    sizes = lambda df: sorted(map(tuple, df.groupBy("window").agg(F.countDistinct("sequence_id"), F.sum("length")).collect()))
    assert sizes(result) == sizes(packed)


def test_language(steps):
    docs, done = steps["language_id"]
    classifier = Classifier(fit(docs))
    good = [r for r in _rows(docs) if (found := classifier.predict(r[1]))[0] != "und" and found[1] >= 0.002]
    assert _rows(done) == good and len(good) > 0.95 * docs.count()


def test_near_duplicates(steps):
    docs, done = steps["simhash_dedup"]
    rows = _rows(docs)
    firsts = {component for _, _, component in test_simhash_dedup._expected(rows, 3, 2)}
    assert _rows(done) == [r for r in rows if r[0] in firsts] and len(firsts) < len(rows)


def test_passages(steps):
    docs, done = steps["substring_dedup"]
    rows = _rows(docs)
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", text_key(F.col("text")).alias("k")).collect()}
    want = test_substring_dedup._expected(rows, keys, test_substring_dedup.MIN_WORDS)
    assert _rows(done) == [(d, want[d, t], lang) for d, t, lang in rows]
    assert done.filter("n_chars <> char_length(text)").count() == 0


def test_benchmark(spark, steps):
    docs, done = steps["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    rows = _rows(docs)
    clean = [r for r, e in zip(rows, test_decontamination._expected(rows, items), strict=True) if not e[-1]]
    assert _rows(done) == clean and len(clean) < len(rows)


def test_packed(steps):
    docs, done = steps["packing"]
    test_packing._check(done.collect(), [(d, t) for d, t, _ in _rows(docs)], 4096)


def test_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert names == list(QUERIES) and [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and list(inspect.signature(corpus_pipeline.run).parameters) == ["spark", "sf_dir"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_any_column_names_pass_through(spark):
    docs = cases.table(spark).withColumnsRenamed({"row": "odd name", "hash": "a.b", "part": "select"}).withColumn("list", F.array(F.lit(1)))
    bench = spark.createDataFrame([(1, "x y z")], "item_id long, text string")
    for kept in (keep_identified(docs, docs), drop_repeated_sentences(docs), drop_near_duplicates(docs), drop_contaminated(docs, bench)):
        assert kept.columns == docs.columns and kept.count() > 50
