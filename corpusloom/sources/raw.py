"""Raw records of four sources -> canonical records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.functions import patterns as P
from corpusloom.functions.frames import once, ship_package
from corpusloom.functions.text import compact_whitespace
from corpusloom.operators.schema import EMPTY_MAP, normalize_records, sql_list
from corpusloom.sources.html import html_lines

TEXT_FIELDS = [
    "source", "id", "text", "url", "title", "domain", "language", "html", "content", "body", "code",
    "instruction", "prompt", "query", "input", "context", "output", "response", "answer",
]
RAW = T.StructType([T.StructField(f, T.StringType()) for f in TEXT_FIELDS]).add("metadata", T.MapType(T.StringType(), T.StringType()))


def first_of(*names: str) -> str:
    """SQL for the first value that is neither NULL nor empty, else ''."""
    return f"coalesce({', '.join(f"nullif({n}, '')" for n in names)}, '')"


def stripped(x: str) -> str:
    return f"btrim({x}, '{P.WS_CHARS}')"


def instruction_text() -> str:
    """Instruction / Input / Output lines; the input line only if it is not blank; else the plain text."""
    instruction = first_of("instruction", "prompt", "query")
    given_input = first_of("input", "context")
    output = first_of("output", "response", "answer")
    input_line = f"CASE WHEN {stripped(given_input)} <> '' THEN concat('Input: ', {stripped(given_input)}) END"
    lines = f"concat_ws(chr(10), concat('Instruction: ', {stripped(instruction)}), {input_line}, concat('Output: ', {stripped(output)}))"
    return f"CASE WHEN {instruction} = '' AND {output} = '' THEN text ELSE {lines} END"


def infer_domain() -> str:
    known = "CASE source WHEN 'code' THEN 'code' WHEN 'document' THEN 'education' WHEN 'web' THEN 'technology' ELSE 'general' END"
    return f"coalesce(nullif(domain, ''), {known})"


def extract_html(df: DataFrame, html: str, name: str = "text") -> DataFrame:
    """Add the readable text of an HTML column; NULL stays NULL."""
    return once(ship_package(df).withColumn("_lines", html_lines(html)), **{name: compact_whitespace("_lines")}).drop("_lines")


def parse_raw(df: DataFrame, only: str | None = None) -> DataFrame:
    """Canonical rows from raw ones (any subset of the RAW columns; others, like ``ord``, pass through).

    ``only`` says that all rows have this source, which leaves out what the other sources need.
    """
    passed = [c for c in df.columns if c not in RAW.names]
    absent = [f"cast(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW if f.name not in df.columns]
    fixed = {"source": f"'{only}'" if only else "coalesce(nullif(source, ''), 'unknown')", "text": first_of("text")}
    df = df.selectExpr("*", *absent)
    df = df.selectExpr(*[f"{fixed[c]} AS {c}" if c in fixed else f"`{c}`" for c in df.columns])

    # Per source: its text, and the name of its parser.
    branches = {
        "document": (first_of("content", "body", "text"), f"'{P.PARSER_DOCUMENT}'"),
        "code": (first_of("code", "text"), f"'{P.PARSER_CODE}'"),
        "instruction": (instruction_text(), f"'{P.PARSER_INSTRUCTION}'"),
        "web": ("coalesce(_page_text, text)", f"CASE WHEN _page IS NOT NULL THEN '{P.PARSER_HTML}' ELSE '{P.PARSER_PLAIN}' END"),
    }
    if only:
        branches = {n: b for n, b in branches.items() if n == only}
    if "web" in branches:
        # A given html field wins even when it is empty.
        looks_like_html = "contains(lower(text), '<html') OR contains(lower(text), '<p')"
        page = f"CASE WHEN source <> 'web' THEN NULL WHEN html IS NOT NULL THEN html WHEN {looks_like_html} THEN text END"
        df = extract_html(df.selectExpr("*", f"{page} AS _page"), "_page", "_page_text")

    def by_source(which: int, fallback: str) -> str:
        cases = " ".join(f"WHEN '{name}' THEN {branch[which]}" for name, branch in branches.items())
        return f"CASE source {cases} ELSE {fallback} END" if cases else fallback

    given = f"coalesce(metadata, {EMPTY_MAP})"
    own = {
        "url": first_of("url", f"{given}['url']"),
        "title": first_of("title", f"{given}['title']"),
        "parser": by_source(1, f"'{P.PARSER_PLAIN}'"),
        "version": f"coalesce({given}['version'], '{P.METADATA_DEFAULTS['version']}')",
    }
    others = f"map_filter({given}, (k, v) -> k NOT IN ({sql_list(list(own))}))"
    metadata = f"map_concat({others}, map({', '.join(f"'{k}', {v}" for k, v in own.items())}))"
    return normalize_records(
        df.selectExpr(
            *[f"`{c}`" for c in passed],
            f"{first_of('id')} AS id",
            f"{by_source(0, 'text')} AS text",
            "source",
            "language",
            f"{infer_domain()} AS domain",
            f"{metadata} AS metadata",
        )
    )
