"""DuckDB SQL for the queries that SQL can express, written from their contracts and rules."""

from __future__ import annotations

from corpusloom.llm.line_quality import BOILERPLATE, CRUMBS, MAX_LOST, MAX_REPEATED, MAX_SYMBOLS, MIN_WORDS, NAVIGATION, SPAN
from corpusloom.llm.line_quality import END_PUNCTUATION as END

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hex_digits: str) -> str:
    """Forty hexadecimal digits as base 32: five digits are four characters."""
    groups = [f"('0x' || substr({hex_digits}, {i}, 5))::BIGINT" for i in range(1, 41, 5)]
    return " || ".join(f"substr('{_BASE32}', (({g} >> {shift}) & 31)::INTEGER + 1, 1)" for g in groups for shift in (15, 10, 5, 0))


WARC = f"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
  hashed AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS sha FROM payloads),
  placed AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM hashed)
  SELECT page_id, payload_bytes, {_base32('sha')} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM placed"""

_BETWEEN = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_BETWEEN}'), lambda w: w <> '')"


DECONTAMINATION = f"""WITH d AS MATERIALIZED (SELECT doc_id, {_words('text')} AS words FROM documents),
  b AS MATERIALIZED (SELECT item_id, words, least(13, len(words)) AS n FROM (SELECT item_id, {_words('text')} AS words FROM benchmark) WHERE len(words) > 0),
  sizes AS (SELECT DISTINCT n FROM b),
  theirs AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS span FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM b)),
  ours AS MATERIALIZED (SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS span
    FROM (SELECT doc_id, words, n, unnest(range(1, greatest(len(words) - n + 2, 1))) AS i FROM d, sizes)),
  met AS MATERIALIZED (SELECT doc_id, item_id, i, n FROM ours JOIN theirs USING (n, span)),
  hits AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM met)) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
  FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

_SPACE = r"[\x20\x09-\x0D]+"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''").replace(r"\"", '"')


def _split(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{_SPACE}'), lambda w: w <> '')"


def _symbols(text: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '[#*$%&|<>]', '', 'g')))"


_PASSES = f"""regexp_matches(line, '{_quoted(END)}') AND NOT {_symbols('line')} > {MAX_SYMBOLS} * len({_split('line')})
    AND NOT regexp_matches(line, '{_quoted(BOILERPLATE)}')
    AND NOT regexp_matches(line, '{_quoted(NAVIGATION)}') AND NOT regexp_matches(line, '{_quoted(CRUMBS)}')"""

LINE_QUALITY = f"""WITH d AS MATERIALIZED (SELECT doc_id, text, {_split('text')} AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
  spans AS (SELECT doc_id, i, array_to_string(words[i : i + {SPAN - 1}], ' ') AS span FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {SPAN - 2}, 1))) AS i FROM d)),
  again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, span) AS n FROM spans) WHERE n > 1),
  repeated AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + {SPAN})) AS place FROM again) GROUP BY doc_id),
  judged AS (SELECT doc_id, length(line) AS n, {_PASSES} AS good FROM (SELECT doc_id, unnest(lines) AS line FROM d)),
  lost AS (SELECT doc_id, sum(n) AS n, sum(n) FILTER (good) AS left_n FROM judged GROUP BY doc_id),
  counted AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, {_symbols('text')}::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    coalesce(1 - coalesce(l.left_n, 0)::DOUBLE / l.n::DOUBLE, 0) AS lost FROM d LEFT JOIN repeated r USING (doc_id) LEFT JOIN lost l USING (doc_id))
  SELECT * EXCLUDE (lost), base_failed, NOT base_failed AND lost <= {MAX_LOST}::DOUBLE AS kept
  FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted)"""
LINE_QUALITY = LINE_QUALITY.replace("SELECT * EXCLUDE (lost), base_failed,", "SELECT * EXCLUDE (lost, base_failed), base_failed,")

_FINITE = """(SELECT *, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

TOP_K = f"""WITH vectors AS MATERIALIZED (SELECT vec_id, v::DOUBLE[] AS v FROM {_FINITE}),
  scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scores QUALIFY rank <= 5"""


def _vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    def nearest(book: str) -> str:
        """The smallest (distance, entry) of each part as one number."""
        apart = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return f"SELECT id, p, x, min({apart} * {entries} + e)::BIGINT AS best FROM parts JOIN {book} USING (p) GROUP BY id, p, x"

    steps = [
        f"vectors AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label, v, len(v) // {parts} AS w FROM {_FINITE})",
        f"parts AS MATERIALIZED (SELECT id, p, v[p * w + 1 : p * w + w] AS x FROM (SELECT *, unnest(range({parts})) AS p FROM vectors))",
        f"book0 AS MATERIALIZED (SELECT p, id AS e, x AS c FROM parts WHERE id < {entries})",
    ]
    for r in range(rounds):
        steps += [
            f"near{r} AS MATERIALIZED (SELECT p, best % {entries} AS e, x, unnest(range(1, len(x) + 1)) AS i FROM ({nearest(f'book{r}')}))",
            f"mean{r} AS (SELECT p, e, list(m ORDER BY i) AS m FROM (SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM near{r} GROUP BY p, e, i) GROUP BY p, e)",
            f"book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM book{r} LEFT JOIN mean{r} USING (p, e))",
        ]
    last = f"book{rounds}"
    return "WITH " + ",\n  ".join([
        *steps,
        f"codes AS MATERIALIZED (SELECT id, string_agg(lower(printf('%02x', best % {entries})), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM ({nearest(last)}) GROUP BY id)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM {last})",
    ]) + "\n  SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM vectors JOIN codes USING (id), digest"


SQL: dict[str, str] = {
    "op3_warc": WARC, "op6_decontamination": DECONTAMINATION, "op9_line_quality": LINE_QUALITY, "op11_topk_search": TOP_K, "op13_vector_codes": _vector_codes(),
}
