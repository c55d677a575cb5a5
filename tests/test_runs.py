"""Whole runs on a small corpus of files, and every query against its SQL."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from corpusloom.plans import queries, runs
from corpusloom.plans.config import RunConfig
from corpusloom.plans.oracle import SQL
from corpusloom.plans.queries import QUERIES
from corpusloom.sources import sinks
from corpusloom.sources.jsonl import load_corpus

SMALL = "/root/testdata/sf0.001"
SENTENCE = "Rivers carry sand and silt from the mountains to the sea, and the coast grows where they slow down."


@pytest.fixture
def folder(tmp_path):
    files = {
        "document.jsonl": [
            {"content": SENTENCE}, {"content": SENTENCE.upper()}, {"content": SENTENCE.replace("sea", "bay")}, {"content": " "},
            {"content": "Lighthouses were built on headlands long before there were charts of the currents around them."},
        ],
        "web.jsonl": [{"url": "u", "html": f"<html><nav>menu</nav><p>{'Bread needs flour, water, salt and time to rise well. ' * 2}</p></html>"}, {"text": "Contact: someone@example.com for all further questions about it."}],
        "code.jsonl": [{"code": "def add(a, b):\n    return a + b\n\nclass Pair:\n    pass\n\nprint(add(1, 2))\n"}],
    }
    (tmp_path / "raw").mkdir()
    for name, rows in files.items():
        (tmp_path / "raw" / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    return tmp_path


def table(path):
    [part] = path.glob("part-*.csv")
    return [line.split(",") for line in part.read_text(encoding="utf-8-sig").splitlines()]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getPath() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_written_outputs_leave_no_shuffle_and_are_compressed(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").alias("ord"), F.repeat(F.lit(SENTENCE), 3).alias("text"), F.lit("web").alias("source"))
    before = shuffle_files(spark)
    sinks.write_jsonl(rows, str(tmp_path / "lines"))
    sinks.write_corpus(rows.repartition(4, "ord"), str(tmp_path / "corpus"), "source")
    assert not shuffle_files(spark) - before
    assert [p for p in (tmp_path / "corpus").rglob("part-*") if not p.name.endswith(".zstd.parquet")] == []
    assert spark.read.json(str(tmp_path / "lines")).count() == spark.read.parquet(str(tmp_path / "corpus")).count() == 2000


def test_raw_files_are_compressed_lines_in_order(spark, tmp_path):
    texts = [f"{i} {SENTENCE}" for i in range(300)]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    before = shuffle_files(spark)
    path = queries.raw_files(spark, str(tmp_path))
    assert not shuffle_files(spark) - before
    files = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
    assert sum(p.stat().st_size for p in files) < sum(map(len, texts)) / 3
    rows = load_corpus(spark, path, pattern=queries.RAW_FILES).orderBy("ord").collect()
    assert [(r.ord, r.text) for r in rows] == list(enumerate(texts, 1))


def test_full_run_and_report(spark, folder):
    config = RunConfig.of({"sampling": {"max_records": 10, "source_ratios": {"web": 0.5, "document": 0.5}}, "dedup": {"approximate_threshold": 0.8}})
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(scratch.iterdir())
    paths = runs.run(spark, str(folder / "raw"), str(folder / "out"), config)
    assert set(scratch.iterdir()) == before  # nothing is left of the run's own tables
    metrics = json.loads("".join(p.read_text() for p in (folder / "out" / "metrics").glob("part-*")))
    assert metrics["ingest"] == {"raw_records": 8, "records_by_source": {"document": 5, "web": 2, "code": 1}}
    assert metrics["cleaning"]["filter_reasons"] == {"empty_text": 1, "pii_detected": 1} and metrics["cleaning"]["kept_records"] == 6
    assert metrics["dedup"]["exact"]["duplicates_removed"] == 1 and metrics["dedup"]["approximate"]["duplicates_removed"] == 1
    assert metrics["dedup"]["output_records"] == 4 and metrics["dedup"]["duplicate_rate"] == 2 / 6
    assert metrics["sampling"]["train_records"] == 4 and metrics["sampling"]["quality_candidates"] == 4
    train = [json.loads(x) for p in sorted((folder / "out" / "train").glob("part-*")) for x in p.read_text().splitlines()]
    assert [r["source"] for r in train] == ["web", "document", "document", "code"]
    assert list(train[0]) == ["text", "source", "token_count", "quality_score", "metadata"]
    assert train[0]["metadata"]["quality_bucket"] == "high" and train[0]["metadata"]["url"] == "u"
    clean = spark.read.parquet(paths["clean"])
    assert clean.count() == 8 and clean.filter("token_count <> 0").count() == 0
    assert spark.read.parquet(paths["processed"]).select("dedup_signature").distinct().count() == 4
    assert table(folder / "out" / "filtered_reasons") == [["filter_reason", "count"], ["empty_text", "1"], ["pii_detected", "1"]]
    assert table(folder / "out" / "safety_flags") == [["safety_flag", "count"], ["email", "1"]]

    again = runs.run_report(spark, paths["train"], str(folder / "again"))
    assert table(folder / "again" / "source_distribution") == table(folder / "out" / "source_distribution")
    assert table(folder / "again" / "quality_distribution")[1:] == [["high", "4"], ["medium", "0"], ["low", "0"]]
    assert table(folder / "again" / "filtered_reasons") == [["filter_reason", "count"]] and again["core"]


def test_a_run_goes_on_where_it_stopped(spark, folder, monkeypatch):
    """After the interim table is written the input isn't scanned again, and the result is that of an unbroken run."""
    config = RunConfig.of({"sampling": {"max_records": 3}})
    raw, out = str(folder / "raw"), str(folder / "out")

    def lost(*args, **named):
        raise RuntimeError("executors lost")

    with monkeypatch.context() as broken:
        broken.setattr(runs, "deduplicate", lost)
        with pytest.raises(RuntimeError, match="executors lost"):
            runs.run(spark, raw, out, config)
    with monkeypatch.context() as unread:
        for scan in ("load_corpus", "count_records"):
            unread.setattr(runs, scan, lost)
        with pytest.raises(RuntimeError):  # other settings: from the start
            runs.run(spark, raw, out, RunConfig.of({"cleaning": {"min_chars": 1}}), resume=True)
        paths = runs.run(spark, raw, out, config, resume=True)
        unread.setattr(runs, "deduplicate", lost)
        paths = runs.run(spark, raw, out, config, resume=True)  # all is done
    whole = runs.run(spark, raw, str(folder / "whole"), config)
    read = lambda p: json.loads("".join(r.value for r in spark.read.text(p).collect()))
    again, want = read(paths["metrics"]), read(whole["metrics"])
    for metrics in (again, want):
        del metrics["sampling"]["train_path"]
    assert again == want and spark.read.text(paths["train"]).collect() == spark.read.text(whole["train"]).collect()
    with pytest.raises(Exception, match="exist"):
        runs.run(spark, raw, out, config)


def test_clean_run(spark, folder):
    path = runs.run_clean(spark, str(folder / "raw"), str(folder / "cleaned"))
    rows = [json.loads(x) for p in sorted((folder / "cleaned").glob("part-*")) for x in p.read_text().splitlines()]
    assert path == str(folder / "cleaned") and [r["id"] for r in rows] == [f"doc_{i:06d}" for i in range(1, 9)]
    assert rows[4]["filter_reason"] == "empty_text" and rows[0]["language"] == "code"


def test_empty_input_is_an_error(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("\n")
    with pytest.raises(FileNotFoundError):
        runs.run(spark, str(tmp_path), str(tmp_path / "out"))


def test_dedup_switches(spark, folder):
    config = RunConfig.of({"dedup": {"exact": False, "approximate": False}})
    runs.run(spark, str(folder / "raw"), str(folder / "out"), config)
    metrics = json.loads("".join(p.read_text() for p in (folder / "out" / "metrics").glob("part-*")))
    assert metrics["dedup"] == {"input_records": 6, "output_records": 6, "duplicates_removed": 0, "duplicate_rate": 0.0}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), SQL[name]) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) and entry.entry(spark).columns


def test_clean_stream(spark, folder):
    from corpusloom.streaming.clean_stream import run_clean_stream

    def step():
        run_clean_stream(spark, str(folder / "raw"), str(folder / "stream"), str(folder / "state")).awaitTermination()
        return {(r.source, r.text, r.filter_reason) for r in spark.read.parquet(str(folder / "stream")).collect()}

    batch = runs.run_clean(spark, str(folder / "raw"), str(folder / "cleaned"))
    want = {(r.source, r.text, r.filter_reason) for r in spark.read.json(batch).collect()}
    assert step() == want
    (folder / "raw" / "late.jsonl").write_text(json.dumps({"source": "web", "text": "too short"}) + "\n")
    assert step() == want | {("web", "too short", "too_short")}


def test_stream_keeps_broken_lines_apart(spark, tmp_path):
    from corpusloom.streaming.clean_stream import run_clean_stream, run_rejected_stream

    (tmp_path / "raw").mkdir()
    lines = ["{broken", "[1]", "", json.dumps({"text": SENTENCE}), json.dumps({"text": SENTENCE, "source": None})]
    (tmp_path / "raw" / "web.jsonl").write_text("\n".join(lines) + "\n")
    run_clean_stream(spark, str(tmp_path / "raw"), str(tmp_path / "good"), str(tmp_path / "state1")).awaitTermination()
    run_rejected_stream(spark, str(tmp_path / "raw"), str(tmp_path / "bad"), str(tmp_path / "state2")).awaitTermination()
    assert sorted(r.source for r in spark.read.parquet(str(tmp_path / "good")).collect()) == ["unknown", "web"]
    assert sorted((r.value, r.problem) for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [("[1]", "JSONL line must be an object"), ("{broken", "Invalid JSON")]


def test_duplicate_lists_are_written(spark, folder):
    config = RunConfig.of({"dedup": {"approximate_threshold": 0.8}})
    paths = runs.run(spark, str(folder / "raw"), str(folder / "out"), config)
    ids, pairs = spark.read.json(paths["duplicate_ids"]).collect(), spark.read.json(paths["duplicate_pairs"]).collect()
    assert [(r.id, r.kept_id) for r in ids] == [("doc_000003", "doc_000002")]
    assert [(r.record_id, r.duplicate_of) for r in pairs] == [("doc_000004", "doc_000002")] and 0.8 <= pairs[0].similarity < 1
