"""Files and tables in, canonical rows out."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.schema import CANONICAL, normalize_records, validate_records
from corpusloom.sources import sinks
from corpusloom.sources.jsonl import load_corpus, make_record_id, read_lines, read_train, rejected_lines
from corpusloom.sources.raw import parse_raw


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines) + "\n", encoding="utf-8")


@pytest.fixture
def corpus(tmp_path):
    write(tmp_path, "web.jsonl", {"url": "u1", "html": "<p>Hello<nav>x</nav>"}, "", {"source": "web", "text": "<P>tag</P> soup", "metadata": {"title": "t", "k": 5}}, {"source": None, "text": "null source"})
    write(tmp_path, "code.jsonl", {"source": "code", "code": "x = 1\n", "id": "given"}, "   ", {"source": "code", "text": "y = 2", "domain": "tools"})
    write(tmp_path, "instruction.jsonl", {"instruction": " do ", "input": "  ", "output": " done "}, {"prompt": "p", "context": "c", "answer": ""}, {"text": "only text"}, {"source": "instruction", "instruction": 0, "response": "r"})
    write(tmp_path, "document.jsonl", {"content": "", "body": "body", "text": "text", "language": "en"}, {"source": "elsewhere", "text": "t"}, {"source": "web", "html": "", "text": "unused"})
    write(tmp_path, "notes.txt", "not a corpus file")
    return tmp_path


def test_load_corpus(spark, corpus):
    rows = load_corpus(spark, str(corpus)).orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(1, 13))
    got = [(r.id, r.source, r.text, r.domain, r.metadata["parser"]) for r in rows]
    assert got == [
        ("given", "code", "x = 1\n", "code", "code_plain_text"),
        ("doc_000002", "code", "y = 2", "tools", "code_plain_text"),
        ("doc_000003", "document", "body", "education", "document_plain_text"),
        ("doc_000004", "unknown", "t", "general", "plain_text"),
        ("doc_000005", "web", "", "technology", "beautifulsoup_html"),
        ("doc_000006", "instruction", "Instruction: do\nOutput: done", "general", "instruction_template"),
        ("doc_000007", "instruction", "Instruction: p\nInput: c\nOutput: ", "general", "instruction_template"),
        ("doc_000008", "instruction", "only text", "general", "instruction_template"),
        ("doc_000009", "instruction", "Instruction: \nOutput: r", "general", "instruction_template"),
        ("doc_000010", "web", "Hello", "technology", "beautifulsoup_html"),
        ("doc_000011", "web", "tag\nsoup", "technology", "beautifulsoup_html"),
        ("doc_000012", "unknown", "null source", "general", "plain_text"),
    ]
    assert rows[10].metadata == {"title": "t", "k": "5", "url": "", "parser": "beautifulsoup_html", "version": "clean_v1"}
    assert rows[2].language == "en" and rows[0].language == "unknown"
    one = load_corpus(spark, str(corpus / "document.jsonl")).orderBy("ord").collect()
    assert [r.source for r in one] == ["document", "unknown", "web"]


def test_order_over_many_blocks(spark, tmp_path):
    for name in ("b.jsonl", "a.jsonl"):
        write(tmp_path, name, *[{"text": f"{name}-{i}" + "x" * (i % 50)} if i % 7 else "" for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = load_corpus(spark, str(tmp_path)).select("ord", "text").orderBy("ord").collect()
        lines = read_lines(spark, str(tmp_path)).filter("file_name = 'a.jsonl' AND value <> ''").orderBy("line_no").collect()
        assert read_lines(spark, str(tmp_path)).select("block").distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [f"{n}-{i}" + "x" * (i % 50) for n in ("a.jsonl", "b.jsonl") for i in range(2000) if i % 7]
    assert [r.text for r in rows] == want and [r.ord for r in rows] == list(range(1, len(want) + 1))
    assert [r.line_no for r in lines] == [i + 1 for i in range(2000) if i % 7]


def test_bad_lines(spark, tmp_path):
    write(tmp_path, "x.jsonl", {"text": "ok"}, "", "{broken", "[1, 2]", "null", {"text": "fine"})
    path = str(tmp_path)
    with pytest.raises(Exception, match=r"Invalid JSON in x.jsonl line 3|must be an object: x.jsonl line [45]"):
        load_corpus(spark, path).collect()
    assert [r.text for r in load_corpus(spark, path, strict=False).orderBy("ord").collect()] == ["ok", "fine"]
    got = sorted((r.line_no, r.problem) for r in rejected_lines(spark, path).collect())
    assert got == [(3, "Invalid JSON"), (4, "JSONL line must be an object"), (5, "JSONL line must be an object")]


def test_record_ids(spark):
    ids = spark.createDataFrame([(1,), (999999,), (1234567,)], "n bigint").select(make_record_id(F.col("n")), make_record_id(F.col("n"), "x")).collect()
    assert [tuple(r) for r in ids] == [("doc_000001", "x_000001"), ("doc_999999", "x_999999"), ("doc_1234567", "x_1234567")]


def test_parsing_with_known_source_is_the_same(spark):
    rows = [("web", "<p>a</p>", None, None, None), ("document", "t", "c", None, None), ("code", "t", None, "k", None), ("instruction", "t", None, None, "i")]
    df = spark.createDataFrame(rows, "source string, text string, content string, code string, instruction string")
    every = {r.source: r for r in parse_raw(df).collect()}
    for (source, *_), in [(r,) for r in rows]:
        assert parse_raw(df.filter(F.col("source") == source), only=source).first() == every[source]


def test_normalize_records(spark):
    df = spark.createDataFrame(
        [("s", "", None, "bogus", "klingon", "", "7", "0.5", "email", "false", {"url": "u", "x": "y"}, "extra")],
        "mark string, id string, text string, source string, language string, domain string, token_count string, quality_score string,"
        " safety_flags string, filtered string, metadata map<string,string>, more string",
    )
    r = normalize_records(df).first()
    assert (r.id, r.text, r.source, r.language, r.domain, r.token_count, r.quality_score) == ("", "", "unknown", "unknown", "unknown", 7, 0.5)
    assert (r.safety_flags, r.filtered, r.filter_reason, r.more, r.mark) == (["email"], True, "", "extra", "s")
    assert r.metadata == {"url": "u", "x": "y", "title": "", "parser": "", "version": "clean_v1"}
    empty = normalize_records(spark.createDataFrame([(None,)], "token_count string"))
    assert [f.name for f in empty.schema if f.name in CANONICAL.names] == CANONICAL.names and empty.first().token_count == 0


def test_validate_records(spark):
    good = normalize_records(spark.createDataFrame([("a", "web", "en")], "id string, source string, language string"))
    assert tuple(validate_records(good).select("valid", "invalid_field").first()) == (True, "")
    broken = {
        "source": F.lit("radio"), "language": F.lit("fr"), "token_count": F.lit("7"), "quality_score": F.lit("x"), "safety_flags": F.lit("email"),
        "filtered": F.lit(1), "metadata": F.lit("{}"), "id": F.lit(7), "text": F.lit(None).cast("string"),
    }
    for name, value in broken.items():
        assert tuple(validate_records(good.withColumn(name, value)).select("valid", "invalid_field").first()) == (False, name)
    assert tuple(validate_records(good.drop("domain")).select("valid", "invalid_field").first()) == (False, "domain")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "é", None), (1, "中", "x")], "ord bigint, text string, note string")
    sinks.write_jsonl(df, str(tmp_path / "out"))
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"text":"中","note":"x"}', '{"text":"é","note":null}']
    sinks.write_csv(df.filter("ord > 5"), str(tmp_path / "csv"), ["text", "note"])
    [part] = (tmp_path / "csv").glob("part-*")
    assert part.read_bytes() == b"\xef\xbb\xbftext,note\n"
    sampled = spark.createDataFrame([(i, f"t{i}", "web", i, 0.5, {"k": "v"}) for i in range(50, 0, -1)], "train_rank bigint, text string, source string, token_count bigint, quality_score double, metadata map<string,string>")
    sinks.export_train(sampled, str(tmp_path / "train"))
    back = read_train(spark, str(tmp_path / "train")).orderBy("train_rank").collect()
    assert [(r.train_rank, r.text, r.metadata) for r in back] == [(i, f"t{i}", {"k": "v"}) for i in range(1, 51)]


def test_equal_file_names_in_two_folders(spark, tmp_path):
    from corpusloom.sources.jsonl import load_corpus, read_lines

    for k in (1, 2):
        (tmp_path / f"k={k}").mkdir()
        (tmp_path / f"k={k}" / "a.jsonl").write_text("".join(json.dumps({"text": f"{k}-{i}"}) + "\n" for i in range(3)))
    rows = sorted((r.ord, r.id, r.text) for r in load_corpus(spark, str(tmp_path)).collect())
    assert rows == [(n + 1, f"doc_{n + 1:06d}", f"{1 + n // 3}-{n % 3}") for n in range(6)]
    assert sorted(r.line_no for r in read_lines(spark, str(tmp_path)).collect()) == [1, 1, 2, 2, 3, 3]


def test_every_turn_is_in_a_record(spark, tmp_path):
    from corpusloom.sources.tables import turn_records

    turns = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "and?"), (1, 4, "user", "so?"), (1, 5, "assistant", "yes"),
             (1, 6, "assistant", "no"), (1, 7, "system", "end"), (2, 0, "assistant", "first"), (2, 1, "tool", "t"), (2, 2, None, "n"), (2, 3, "user", None)]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted(tuple(r) for r in turn_records(spark, str(tmp_path)).collect())
    assert got == [
        (1, 1, "hi", "be brief", "hello", "be brief"), (1, 3, "and?", "", "", ""), (1, 4, "so?", "", "yes", ""), (1, 6, "", "", "no", "no"), (1, 7, "", "", "", "end"),
        (2, 0, "", "", "first", "first"), (2, 1, "", "", "", "t"), (2, 2, "", "", "", "n"), (2, 3, "", "", "", ""),
    ]
