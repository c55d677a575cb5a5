"""Row-level functions on hand-made values, and against plain Python on odd characters."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import patterns as P
from corpusloom.functions import text as X
from corpusloom.functions.frames import once
from corpusloom.functions.rounding import python_round
from corpusloom.operators import cleaning, quality, tokens
from corpusloom.operators.dedup import simhash_signatures
from corpusloom.plans import queries
from corpusloom.plans.config import CleanConfig
from corpusloom.sources.html import page_lines

ODD = [
    "", "   ", "a", "  x\x00  y\r\n\r\n\r\nz\t中文  ", "tab\t\tand \t blank", " \n \n \n a \n\n\n\n b", "　全角　", "zero​width﻿bom",
    "emoji 😀😀😀 end", "系user@example.com", "mail me: a.b+c@mail.example.org!", "tel 13812345678.", "tel 138123456789", "+86 138-1234-5678 and (555) 123-4567",
    "id 11010519491231002X", "id 110105194912310021", "n 123456789012345", "access_key: 'k-12345678'", "TOKEN = abcdefgh", "ſecret: abcdefghij", "sk-ABCDEFGHIJK",
    "Bearer abc.def", "my password", "passwords", "HTTP://A.com www.b.org https://c wwww", "if x for y while", "ififif _if if_ ifé éif if", "aaa  aaa\n\n\n", "ééééé aa",
    "def f(x):\n    return {x: [1, 2.5, 3]}", "it's 3.14 don't ''' 12.x .5 ٣٤.٥", "１２３４５６７８９０", "²³ ½ Ⅷ ①", "x\x1cy\x1fz", "\x0b\x0c", "Ｆｕｌｌ　Ｗｉｄｔｈ", "中文abc混合12",
]


def evaluate(spark, values, *columns):
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


NORMAL = {
    "  x\x00  y\r\n\r\n\r\nz\t中文  ": "x y\n\nz 中文", "tab\t\tand \t blank": "tab and blank", " \n \n \n a \n\n\n\n b": "a\n\nb", "\u3000全角\u3000": "全角",
    "zero\u200bwidth\ufeffbom": "zerowidthbom", "a\rb\r\nc": "a\nb\nc", "x\x1cy\x1fz": "xyz", "\x0b\x0c": "", "line \n  next": "line\nnext", "😀\x07 end ": "😀 end", "": "",
}


def test_normalized_texts(spark):
    assert [r[0] for r in evaluate(spark, list(NORMAL), X.normalize_text("text"))] == list(NORMAL.values())


def longest_run(text):
    return max((len(m.group()) if not m.group(1).isspace() else 1 for m in re.finditer(r"(?s)(.)\1*", text)), default=0)


def test_text_functions_agree_with_python(spark):
    word, digit = r"[\w]", r"\d"
    got = evaluate(
        spark, ODD, X.hash_form("text"), X.gram_form("text"), X.max_run("text"), X.token_count("text"),
        F.size(X.tokens("text")), X.url_count("text"), X.code_keyword_count("text"), F.array_join(X.pii_flags("text"), ","), X.preview("text", 10),
    )
    keywords = r"\b(?:" + "|".join(P.CODE_KEYWORDS) + r")\b"
    token = r"[一-鿿]|[A-Za-z_]+(?:'[A-Za-z]+)?|\d+(?:\.\d+)?|[^\s]"
    # The patterns of the rules in their plain form.
    flags = {
        "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
        "phone": r"(?<!\d)(?:\+?\d{1,3}[-\s]?)?(?:1[3-9]\d{9}|\d{3}[-.\s]?\d{3}[-.\s]?\d{4})(?!\d)",
        "id_card": r"(?<!\d)(?:\d{15}|\d{17}[\dXx])(?!\d)",
        "api_key": r"(?i)(?:api[_-]?key|access[_-]?key|secret|token|password)\s*[:=]\s*['\"]?[A-Za-z0-9_\-]{8,}|sk-[A-Za-z0-9_\-]{10,}",
        "sensitive_keyword": r"(?i)\b(?:password|secret|api[_-]?key|access[_-]?token|bearer\s+[A-Za-z0-9_\-.]+)\b",
    }
    for text, row in zip(ODD, got):
        hashed = re.sub(r"\s+", " ", text.lower().strip())
        short = " ".join(text.split())
        assert row == (
            hashed, re.sub(r"\s+", "", hashed), longest_run(text), len(re.findall(token, text)), len(re.findall(token, text)),
            len(re.findall(r"https?://\S+|www\.\S+", text, re.I)), len(re.findall(keywords, text)),
            ",".join(n for n, p in flags.items() if re.search(p, text)), short if len(short) <= 10 else short[:7] + "...",
        ), text


def test_counters_agree_with_python(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "i int, text string")
    for r in cleaning.with_counters(df).select("i", "text", "counters.*").collect():
        seen = [c for c in r.text if not c.isspace()]
        assert (r.length, r.visible, r.zh, r.letters, r.digits) == (
            len(r.text), len(seen), sum("一" <= c <= "鿿" for c in seen), sum(c.isascii() and c.isalpha() for c in seen), sum(c.isdigit() for c in seen),
        ), r.text
        assert (r.symbols, r.alnum, r.distinct) == (sum(c in P.CODE_SYMBOLS for c in seen), sum(c.isalnum() for c in seen), len(set(seen))), r.text


def test_table_of_classes_counts_as_the_patterns_do(spark):
    rng = random.Random(7)
    alphabet = list("ab_Z''..1290٣²Ⅷ中鿿é😀😀~;/ \n\t　 ́") + ["a'b", "it's_a'", "1.2.3", "a'b'c'd", "__", "\U0001d7d8", " if ", "def", "function", "functions", "éif", "if_", "\nwhile("]
    texts = [*ODD, *["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)], "x" * 70_000, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rest = F.regexp_replace(X.visible_chars("text"), "[A-Za-z]+", "")
    words = F.regexp_extract_all("text", F.lit(P.WORD + "+"), F.lit(0))
    plain = {
        "visible": F.length(X.visible_chars("text")), "zh": X.count_class(rest, f"[{P.CJK_RANGE}]"), "letters": F.length(X.visible_chars("text")) - F.length(rest),
        "digits": X.count_class(rest, P.digit_class()), "symbols": X.count_class(rest, P.CODE_SYMBOL_CLASS), "alnum": X.count_class(X.visible_chars("text"), P.ALNUM),
        "distinct": X.count_distinct_chars(X.visible_chars("text")), "max_run": X.max_run("text"), "keywords": F.size(F.filter(words, lambda w: w.isin(P.CODE_KEYWORDS))),
    }
    counted = tokens.add_token_counts(cleaning.with_counters(df)).withColumn("plain", F.struct(*[c.cast("bigint").alias(n) for n, c in plain.items()]))
    for r in counted.withColumn("tokens", X.tokens("text")).collect():
        assert {n: r.counters[n] for n in plain} == r.plain.asDict(), r.text
        assert r.token_count == (None if r.tokens is None else len(r.tokens)), r.text


def test_quality_features_looks_at_each_text_once(spark):
    plan = queries.quality_features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(P.SENSITIVE) == plan.count(P.URL) == 1


def test_flags_of_contact_text(spark):
    [(flags,)] = evaluate(spark, ["ask jo.doe@mail.example.net or ring 15900001111; Token: abcd-1234-efgh, bearer x.y"], X.pii_flags("text"))
    assert flags == ["email", "phone", "api_key", "sensitive_keyword"]


def test_filter_reasons(spark):
    """Each rule just above and below its limit, and which of two rules comes first."""
    config = CleanConfig.of({"min_chars": 24, "max_chars": 90, "max_urls": 1, "repeated_char_threshold": 6})
    plain = "the harbour opens at dawn"  # 25 characters
    cases = {
        plain: "", plain[:24]: "", plain[:23]: "too_short", (plain + " ") * 3 + "calm sea now": "", (plain + " ") * 4: "too_long",
        f"{plain} www.a.org": "", f"{plain} www.a.org https://b.org": "too_many_urls", f"{plain} mmmmm": "", f"{plain} mmmmmm": "repeated_chars",
        f"{plain} mmmmmm https://b.org www.a.org": "too_many_urls", f"{plain} write to crew@ship.example": "pii_detected",
        f"{plain} mmmmmm crew@ship.example": "repeated_chars", "\n\t \n": "empty_text", "(-) [-] {-} <-> |-| /-/ ok": "low_information",
    }
    df = spark.createDataFrame(list(cases.items()), "text string, id string")
    # The expected reason travels along as the record's id; an empty one stays empty.
    for row in cleaning.clean(df, config).collect():
        assert row.filter_reason == row.id, row.text
    few_letters = spark.createDataFrame([("ab" * 40,)], "text string")
    assert cleaning.clean(few_letters, CleanConfig(min_unique_ratio=0.05)).first().filter_reason == "low_information"
    assert cleaning.clean(few_letters, CleanConfig(min_unique_ratio=0.02)).first().filter_reason == ""


def test_languages(spark):
    cases = {
        "这是一个普通的中文句子": "zh", "plain english words": "en", "中文词语与中文 mixed with english": "mixed", "value = {a: [b], c: (d)} + e[0];": "code",
        "for the while": "code", "1234 5678": "unknown", "": "unknown",
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    assert {r.text: r.language for r in cleaning.clean(df).collect()} == cases
    code = spark.createDataFrame([("plain english words", "code")], "text string, source string")
    assert cleaning.clean(code).first().language == "code"


def test_existing_flags_come_first(spark):
    df = spark.createDataFrame([("mail user@example.com", ["phone", "email"])], "text string, safety_flags array<string>")
    assert cleaning.clean(df).first().safety_flags == ["phone", "email"]


def test_ngrams_and_jaccard(spark):
    rows = evaluate(spark, ["abcdef", "ab", "", "A b\nC d E f", "😀😀😀😀"], X.char_ngrams("text", 3))
    assert [sorted(r[0]) for r in rows] == [["abc", "bcd", "cde", "def"], ["ab"], [], ["abc", "bcd", "cde", "def"], ["😀😀😀"]]
    df = spark.createDataFrame([(["a"], ["a"]), (["a"], ["b"]), (["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(X.jaccard("a", "b")).collect()] == [1.0, 0.0, 1 / 3, 1.0, 0.0]


def test_simhash(spark):
    import hashlib

    known = {
        "": -1, "lake": -8748472743240144135, "Lake  and SHORE": 1046854248341398136, "lake and shore": 1046854248341398136, "lake, shore!": -3476377640045122821,
        "湖 和 岸": 3597600120416735839,
    }
    df = spark.createDataFrame(list(enumerate(known)), "i int, text string")
    got = {r.i: r.simhash for r in simhash_signatures(df, "i").collect()}
    assert got == dict(enumerate(known.values()))
    assert known["lake"] == int.from_bytes(hashlib.md5(b"lake").digest()[8:], "big", signed=True)  # one token votes alone
    assert spark.range(1).select(X.hamming(F.lit(-1), F.lit(1))).first()[0] == 63


def test_rounding_is_pythons(spark):
    values = [2.675, 61.465, 0.85625, 0.5, 1.5, 2.5, 0.125, 0.375, 1e-9, 0.0]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double").select(*[python_round(F.col("v"), d).alias(f"d{d}") for d in (0, 2, 4)]).collect()
    assert [tuple(r) for r in rows] == [tuple(float(round(v, d)) for d in (0, 2, 4)) for v in values] + [(None, None, None)]
    assert rows[0].d2 == 2.67 and rows[1].d2 == 61.47 and rows[2].d4 == 0.8562


def test_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (0, 32, 33, 128, 129, 512, 513, 2048, 2049)], "n bigint")
    names = [r[0] for r in df.select(X.length_bucket("n")).collect()]
    assert names == ["0-32", "0-32", "33-128", "33-128", "129-512", "129-512", "513-2048", "513-2048", "2049+"]
    df = spark.createDataFrame([(s,) for s in (1.0, 0.75, 0.7499, 0.45, 0.4499)], "s double")
    assert [r[0] for r in df.select(X.quality_bucket("s")).collect()] == ["high", "high", "medium", "medium", "low"]


def test_quality_features_and_scores(spark):
    good = "Careful data work includes cleaning, deduplication, statistics, scoring and sampling before a corpus is used for anything."
    rows = [
        (1, "Instruction: Say what data quality is.\nOutput: It is fitness for use.", 12, "instruction", "en", []),
        (2, good, 28, "document", "en", []),
        (3, "Keep user@example.com and 13812345678 in the set.", 20, "web", "en", ["email", "phone"]),
        (4, "", 0, "unknown", "unknown", []),
        (5, "no structure here", 20, "instruction", "en", []),
    ]
    df = spark.createDataFrame(rows, "i int, text string, token_count bigint, source string, language string, safety_flags array<string>")
    df = df.withColumn("metadata", F.create_map(F.lit("url"), F.lit("")))
    features = {r.i: r.features for r in quality.extract_features(df).collect()}
    assert features[1].has_instruction_structure and features[1].token_count == 12 and features[3].pii_flag and not features[2].pii_flag
    scores = {r.i: (r.quality_score, r.quality_bucket, r.metadata["quality_bucket"]) for r in quality.add_quality_scores(df).collect()}
    assert scores == {1: (0.78, "high", "high"), 2: (0.88, "high", "high"), 3: (0.33, "low", "low"), 4: (0.07, "low", "low"), 5: (0.76, "high", "high")}


def test_tokenizer_fallback_and_plug_in(spark):
    def broken():
        raise RuntimeError("no such model")

    class Words:
        def tokenize(self, text):
            return text.split()

    assert tokens.Tokenizer("broken", broken).checked(spark) == tokens.Tokenizer(error="no such model")
    df = spark.createDataFrame([("two words",), (None,)], "text string")
    plugged = tokens.add_token_counts(df, tokens.Tokenizer("words", Words).checked(spark))
    assert [r.token_count for r in plugged.collect()] == [2, 0]
    empty = tokens.token_stats(spark.createDataFrame([], "token_count bigint")).first()
    assert tuple(empty) == (0, 0.0, 0, 0)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>T</title><style>p{}</style></head><body>a<!-- c -->b</body></html>", "T\na\nb"),
        ("<p>one<p>two<br>three &amp; four&nbsp;&#233;", "one\ntwo\nthree & four\xa0é"),
        ("<script>var t='</p>';</script>x<nav><ul><li>skip</nav>y", "x\ny"),
        ("<div><header>skip <b>this</b></div>kept", "kept"),
        ("<nav>a<nav>b</nav>c</nav>d</nav>e", "d\ne"),
        ("x &unknown; &am", "x &unknown; &am".replace("&unknown;", "&unknown")),
        ("a<template>no</template><noscript>no</noscript><ruby>b<rt>no</rt></ruby>", "a\nb"),
        ("", ""),
        (None, None),
    ],
)
def test_html(page, text):
    assert page_lines(page) == text


def test_costly_columns_are_not_copied_into_filters(spark):
    df = once(spark.createDataFrame([("a",)], "text string"), text=X.normalize_text("text"))
    plan = once(df, n=X.token_count("text")).filter("n > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("{C}&&") == 1


def test_char_ngrams_digest(spark):
    import hashlib

    texts = [None, "", " \n", "ab", "ABCDE", "abcdef", "aaaaaaaaaa", "one two one two", "😀é中文字符 abc", "| a|b|c"]
    want = []
    for t in texts:
        v = "".join((t or "").lower().split())
        grams = sorted(set() if not v else {v} if len(v) <= 5 else {v[i : i + 5] for i in range(len(v) - 4)})
        want.append((len(grams), hashlib.md5("|".join(grams).encode()).hexdigest()))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = df.select("i", X.char_ngrams_digest("text").alias("d"), F.size(X.char_ngrams("text")).alias("n")).orderBy("i").collect()
    assert [(r.d.grams, r.d.grams_md5) for r in found] == want and [r.n for r in found] == [n for n, _ in want]


def test_verdicts_of_several_configurations_read_the_texts_once(spark, tmp_path):
    from corpusloom.plans import queries

    texts = ["", "short", "a plain text " * 40, "xxxxxxxxxxxxxxxxxxxxxxxxx" * 30, "http://a.b http://c.d " * 40, "mail me@example.com " * 30, None]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.config_scoping(spark, str(tmp_path))
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1
    forms = {"flat": queries.CLEANING, "section": {"cleaning": queries.CLEANING, "min_chars": 1}, "none": None}
    rows = queries.tables.load_tables(spark, str(tmp_path), ("document",))
    want = set()
    for form, c in forms.items():
        config = queries.CleanConfig.of(c)
        cleaned = queries.cleaning.clean(rows, config, canonical=True).filter("filtered")
        want |= {(form, r.filter_reason, r["count"]) for r in cleaned.groupBy("filter_reason").count().collect()}
        same = queries.cleaning.verdicts(rows, config, keep=["ord", "text"]).filter("filtered")
        assert {tuple(r) for r in same.select("ord", "text", "filter_reason").collect()} == {tuple(r) for r in cleaned.select("ord", "text", "filter_reason").collect()}
    assert {tuple(r) for r in found.collect()} == want and len(want) > 4


def test_html_lines_take_arrow_arrays():
    import pyarrow as pa

    from corpusloom.sources.html import html_lines

    pages = pa.array([None, "", "<p>a</p><script>x</script><p>b</p>"] * 200)
    assert html_lines.func(pages).to_pylist() == [None, "", "a\nb"] * 200 and html_lines.func(pages.slice(0, 0)).to_pylist() == []


def test_api_keys_are_looked_for_at_their_openings_alone(spark):
    """The opening rules out most positions, and no match of any alternative."""
    names = ["api_key", "API-KEY", "apikey", "access-key", "Secret", "ſecret", "tOKEN", "toKen", "PASSWORD", "paſſword"]
    good = [f"x {n} = 'abcd_1234" for n in names] + ["sk-abcdefghij", "SK-abcdefghij", "xsK-abcdefghij", "ſk-abcdefghij"]
    bad = ["api_key = abc", "sk-abc", "key: abcdefghij", "a: abcdefghij", "secrets: abcdefghij", ""]
    assert P.API_KEY.startswith("(?=")
    df = spark.createDataFrame([(t,) for t in good + bad], "text string").select("text", F.col("text").rlike(P.API_KEY).alias("found"))
    assert {r.text for r in df.collect() if r.found} == set(good)
