"""The queries of :mod:`corpusloom.plans.queries` in plain SQL (DuckDB), to check results against.

The SQL is written from the rules, not from the Spark plans: lists and windows instead of regex tricks,
patterns without look-around, and a recursive walk for the greedy near-duplicate rule.
"""

from __future__ import annotations

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(8232) || chr(8233) || chr(12288)"
SPACE = r"[\s\v\p{Z}]"
KEYWORDS = "'def','class','import','return','for','while','if','else','try','except','function','const','let','var'"
TOKEN = r"[\x{4e00}-\x{9fff}]|[A-Za-z_]+(?:''[A-Za-z]+)?|[0-9]+(?:\.[0-9]+)?|[^\s\v\p{Z}]"
RATIOS = "(VALUES ('web', 0, 105), ('document', 1, 75), ('code', 2, 60), ('instruction', 3, 60)) q(source, place, target)"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def normalized(x: str) -> str:
    x = rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"
    x = rf"regexp_replace({x}, '[^\P{{C}}\n\t]', '', 'g')"
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = rf"regexp_replace({x}, ' *\n *', chr(10), 'g')"
    x = rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(x)


def hash_form(x: str) -> str:
    return f"regexp_replace({strip(f'lower({x})')}, '{SPACE}+', ' ', 'g')"


def count_only(keep: str, x: str = "visible_text") -> str:
    """Characters of a class: what is left without all others."""
    return f"length(regexp_replace({x}, '[^{keep}]', '', 'g'))::BIGINT"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {b} = 0 THEN 0.0::DOUBLE ELSE {a}::DOUBLE / {b}::DOUBLE END)"


# Each building block reads (ord, text, ...) from the relation it is given.
def runs_of(source: str) -> str:
    """(ord, max_run): islands of equal characters; blanks count as one each."""
    return f"""
    SELECT s.ord, CASE WHEN s.text = '' THEN 0 ELSE coalesce(r.longest, 1) END::BIGINT AS max_run
    FROM {source} s LEFT JOIN (
      SELECT ord, max(n) AS longest FROM (
        SELECT ord, ch, CASE WHEN regexp_matches(ch, '{SPACE}') THEN 1 ELSE count(*) END AS n FROM (
          SELECT ord, ch, pos - row_number() OVER (PARTITION BY ord, ch ORDER BY pos) AS island
          FROM (SELECT ord, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS pos FROM {source})
        ) GROUP BY ord, ch, island
      ) GROUP BY ord
    ) r USING (ord)"""


def counters_of(source: str) -> str:
    symbols = r"{}\[\]();=<>+\-*/_%:\\`|&^~#$"
    return f"""
    SELECT ord, length(text)::BIGINT AS length, length(visible_text)::BIGINT AS visible,
      {count_only(chr(92) + 'x{4e00}-' + chr(92) + 'x{9fff}')} AS zh, {count_only('A-Za-z')} AS letters,
      {count_only(chr(92) + 'p{Nd}')} AS digits, {count_only(symbols)} AS symbols,
      {count_only(chr(92) + 'p{L}' + chr(92) + 'p{N}')} AS alnum,
      (CASE WHEN visible_text = '' THEN 0 ELSE len(list_distinct(string_split(visible_text, ''))) END)::BIGINT AS "distinct",
      len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: w IN ({KEYWORDS})))::BIGINT AS keywords,
      len(regexp_extract_all(text, '(?i)https?://[^\\s]+|www\\.[^\\s]+'))::BIGINT AS urls, max_run
    FROM (SELECT ord, text, regexp_replace(text, '{SPACE}+', '', 'g') AS visible_text FROM {source})
    JOIN ({runs_of(source)}) USING (ord)"""


LANGUAGE = f"""CASE WHEN visible = 0 THEN 'unknown'
      WHEN ({ratio('symbols', 'visible')} > 0.16::DOUBLE AND letters + digits > 8) OR keywords >= 2 THEN 'code'
      WHEN {ratio('zh', 'visible')} > 0.25::DOUBLE AND {ratio('letters', 'visible')} > 0.18::DOUBLE THEN 'mixed'
      WHEN {ratio('zh', 'visible')} > 0.3::DOUBLE THEN 'zh' WHEN {ratio('letters', 'visible')} > 0.5::DOUBLE THEN 'en'
      WHEN {ratio('zh', 'visible')} > 0.08::DOUBLE AND {ratio('letters', 'visible')} > 0.08::DOUBLE THEN 'mixed'
      ELSE 'unknown' END"""

FLAGS = {
    "email": r"(?:^|[^\p{L}\p{N}_])[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?:$|[^\p{L}\p{N}_])",
    "phone": r"(?:^|[^0-9])(?:\+?[0-9]{1,3}[-\s]?)?(?:1[3-9][0-9]{9}|[0-9]{3}[-.\s]?[0-9]{3}[-.\s]?[0-9]{4})(?:$|[^0-9])",
    "id_card": r"(?:^|[^0-9])(?:[0-9]{15}|[0-9]{17}[0-9Xx])(?:$|[^0-9])",
    "api_key": r"(?i)(?:api[_-]?key|access[_-]?key|secret|token|password)\s*[:=]\s*[''\x22]?[A-Za-z0-9_\-]{8,}|sk-[A-Za-z0-9_\-]{10,}",
    "sensitive_keyword": r"(?i)(?:^|[^\p{L}\p{N}_])(?:password|secret|api[_-]?key|access[_-]?token|bearer\s+[A-Za-z0-9_\-.]*[A-Za-z0-9_])(?:$|[^\p{L}\p{N}_])",
}
FLAG_TEXT = "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in FLAGS.items()) + ")"


def reason(min_unique: str = "0.04") -> str:
    return f"""CASE WHEN visible = 0 THEN 'empty_text' WHEN length < 50 THEN 'too_short' WHEN length > 200000 THEN 'too_long'
      WHEN urls > 10 THEN 'too_many_urls' WHEN max_run >= 20 THEN 'repeated_chars' WHEN flags <> '' THEN 'pii_detected'
      WHEN {ratio('alnum', 'visible')} < 0.2::DOUBLE OR {ratio('"distinct"', 'visible')} < {min_unique}::DOUBLE THEN 'low_information'
      ELSE '' END"""


def page_text(x: str) -> str:
    for tag in ("script", "style", "nav", "footer", "noscript", "header"):
        x = rf"regexp_replace({x}, '(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>', chr(10), 'g')"
    x = rf"regexp_replace({x}, '(?s)<!--.*?-->', chr(10), 'g')"
    x = rf"regexp_replace({x}, '(?s)</?[A-Za-z!][^>]*>', chr(10), 'g')"
    for name, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    x = rf"regexp_replace({x}, '&amp$', '&')"
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda s: {strip('s')}), lambda s: s <> '')"
    return strip(rf"regexp_replace(regexp_replace(array_to_string({lines}, chr(10)), '[ \t\r\f\v]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


PAIRS = """SELECT conv_id, turn, text AS question, answer FROM (
      SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant'"""

TURNS = """SELECT conv_id, turn, CASE WHEN role = 'user' THEN own ELSE '' END AS question,
      CASE WHEN role = 'user' AND role_before = 'system' THEN before ELSE '' END AS given,
      CASE WHEN role = 'user' AND role_after = 'assistant' THEN after WHEN role = 'assistant' THEN own ELSE '' END AS answer,
      CASE WHEN role <> 'user' THEN own WHEN role_before = 'system' THEN before ELSE '' END AS alone
    FROM (SELECT conv_id, turn, role, own, coalesce(lag(role) OVER w, '') AS role_before, coalesce(lag(own) OVER w, '') AS before,
        coalesce(lead(role) OVER w, '') AS role_after, coalesce(lead(own) OVER w, '') AS after
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS own FROM conversations)
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    WHERE NOT (role = 'assistant' AND role_before = 'user') AND NOT (role = 'system' AND role_after = 'user')"""

RAW_DOCS = "docs AS MATERIALIZED (SELECT doc_id AS ord, text FROM documents)"
DOCS = f"docs AS MATERIALIZED (SELECT doc_id AS ord, {normalized('text')} AS text FROM documents)"
PLACE = 72057594037927936  # 2^56

CORPUS = f"""
  corpus AS MATERIALIZED (
    SELECT {PLACE} + doc_id AS ord, 'document-' || doc_id AS id, 'document' AS source, text AS raw_text, lang AS language,
      'education' AS domain, '' AS url, 'document_plain_text' AS parser, 'origin=' || source || '|' AS extra FROM documents
    UNION ALL
    SELECT 2 * {PLACE} + conv_id * 65536 + turn, 'conversation-' || conv_id || '-' || turn, 'instruction',
      CASE WHEN question = '' AND answer = '' THEN alone ELSE 'Instruction: ' || {strip('question')} ||
        (CASE WHEN {strip('given')} = '' THEN '' ELSE chr(10) || 'Input: ' || {strip('given')} END) || chr(10) || 'Output: ' || {strip('answer')} END,
      NULL, 'general', '', 'instruction_template', '' FROM ({TURNS})
    UNION ALL
    SELECT 3 * {PLACE} + page_id, 'page-' || page_id, 'web', {page_text('html')}, NULL, 'technology', url, 'beautifulsoup_html', '' FROM pages
  )"""


def cleaned(min_unique: str = "0.04", corpus: str = CORPUS) -> str:
    """(ord, id, source, text, language, flags, filter_reason, counters, domain)."""
    return f"""{corpus},
  normal AS MATERIALIZED (SELECT ord, id, source, domain, {normalized('raw_text')} AS text FROM corpus),
  counted AS MATERIALIZED ({counters_of('normal')}),
  flagged AS MATERIALIZED (SELECT n.*, {FLAG_TEXT} AS flags FROM normal n),
  clean AS MATERIALIZED (SELECT f.*, c.* EXCLUDE (ord), CASE WHEN source = 'code' THEN 'code' ELSE {LANGUAGE} END AS language,
    {reason(min_unique)} AS filter_reason FROM flagged f JOIN counted c USING (ord))"""


DOCS_CORPUS = f"""corpus AS MATERIALIZED (SELECT doc_id AS ord, 'document-' || doc_id AS id, 'document' AS source, text AS raw_text,
    'education' AS domain FROM documents)"""

FEATURES = f"""
    SELECT *, {ratio('max_run', 'length')} AS repeat_char_ratio, {ratio('symbols', 'visible')} AS code_symbol_ratio,
      {ratio('alnum', 'visible')} AS alpha_digit_ratio,
      contains(text, 'Instruction:') AND contains(text, 'Output:') AS has_instruction_structure
    FROM (SELECT *, len(regexp_extract_all(text, '{TOKEN}'))::BIGINT AS token_count FROM clean)"""

SCORE = """round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE
      - (CASE WHEN token_count <= 0 THEN 0.6 WHEN token_count < 15 THEN 0.3 WHEN token_count < 32 THEN 0.12 ELSE 0 END)::DOUBLE
      - (CASE WHEN urls > 10 THEN 0.35 WHEN urls > 3 THEN 0.15 ELSE 0 END)::DOUBLE
      - (CASE WHEN repeat_char_ratio > 0.25::DOUBLE THEN 0.35 WHEN repeat_char_ratio > 0.12::DOUBLE THEN 0.15 ELSE 0 END)::DOUBLE
      - (CASE WHEN flags <> '' THEN 0.55 ELSE 0 END)::DOUBLE - (CASE WHEN language = 'unknown' THEN 0.15 ELSE 0 END)::DOUBLE
      - (CASE WHEN source = 'code' AND code_symbol_ratio > 0.55::DOUBLE THEN 0.1 ELSE 0 END)::DOUBLE
      - (CASE WHEN source <> 'code' AND code_symbol_ratio > 0.3::DOUBLE THEN 0.18 ELSE 0 END)::DOUBLE
      - (CASE WHEN source <> 'code' AND alpha_digit_ratio < 0.35::DOUBLE THEN 0.18 ELSE 0 END)::DOUBLE
      + (CASE WHEN source <> 'instruction' THEN 0 WHEN has_instruction_structure THEN 0.08 ELSE -0.12 END)::DOUBLE)), 4)"""


def bucket(x: str = "quality_score") -> str:
    return f"CASE WHEN {x} >= 0.75 THEN 'high' WHEN {x} >= 0.45 THEN 'medium' ELSE 'low' END"


LENGTH_BUCKET = """CASE WHEN token_count <= 32 THEN '0-32' WHEN token_count <= 128 THEN '33-128' WHEN token_count <= 512 THEN '129-512'
      WHEN token_count <= 2048 THEN '513-2048' ELSE '2049+' END"""


def scored(min_unique: str = "0.0", corpus: str | None = None) -> str:
    return f"""{cleaned(min_unique, corpus or CORPUS)},
  featured AS MATERIALIZED ({FEATURES}),
  scored AS MATERIALIZED (SELECT *, {bucket()} AS quality_bucket FROM (SELECT *, {SCORE} AS quality_score FROM featured))"""


BEST = "quality_score DESC, token_count DESC, ord"


def sampled(candidates: str, ratios: str = RATIOS, limit: int = 300) -> str:
    """(train_rank, ord, ...) from a relation of candidates."""
    return f"""
  quota AS MATERIALIZED (
    SELECT *, least(wanted, {limit} - taken_before) AS take FROM (
      SELECT *, least(coalesce(sum(wanted) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), {limit})::BIGINT AS taken_before
      FROM (SELECT q.source, place, target::BIGINT AS target, coalesce(a.n, 0)::BIGINT AS available, least(target, coalesce(a.n, 0))::BIGINT AS wanted
            FROM {ratios} LEFT JOIN (SELECT source, count(*) AS n FROM {candidates} GROUP BY source) a USING (source)))),
  picked AS MATERIALIZED (
    SELECT (taken_before + place_in_source)::BIGINT AS train_rank, c.* FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY {BEST}) AS place_in_source FROM {candidates}) c
    JOIN quota USING (source) WHERE place_in_source <= take),
  filled AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY {BEST}) + (SELECT count(*) FROM picked))::BIGINT AS train_rank, ord
    FROM {candidates} WHERE id NOT IN (SELECT id FROM picked)),
  sampled AS MATERIALIZED (
    SELECT c.*, train_rank FROM {candidates} c JOIN (
      SELECT train_rank, ord FROM picked UNION ALL SELECT train_rank, ord FROM filled WHERE train_rank <= {limit}) USING (ord))"""


CANDIDATES = "candidates AS MATERIALIZED (SELECT * FROM scored WHERE filter_reason = '' AND quality_score >= 0.45)"


def grams_of(source: str, text: str = "text", key: str = "ord", n: int = 5) -> str:
    """(key, g): the distinct n-grams of a text column."""
    following = " || ".join(f"lead(ch, {k}) OVER w" for k in range(1, n))
    return f"""
    SELECT DISTINCT {key}, g FROM (
      SELECT {key}, ch || {following} AS g FROM (
        SELECT {key}, unnest(string_split(v, '')) AS ch, generate_subscripts(string_split(v, ''), 1) AS pos FROM (
          SELECT {key}, regexp_replace({hash_form(text)}, '{SPACE}+', '', 'g') AS v FROM {source}) WHERE length(v) > {n})
      WINDOW w AS (PARTITION BY {key} ORDER BY pos)) WHERE g IS NOT NULL
    UNION ALL
    SELECT {key}, v FROM (SELECT {key}, regexp_replace({hash_form(text)}, '{SPACE}+', '', 'g') AS v FROM {source}) WHERE length(v) BETWEEN 1 AND {n}"""


def exact(source: str = "docs") -> str:
    return f"""
  signed AS MATERIALIZED (SELECT *, md5({hash_form('text')}) AS dedup_signature FROM {source}),
  firsts AS MATERIALIZED (SELECT * FROM (SELECT *, min(ord) OVER (PARTITION BY dedup_signature) AS first_ord FROM signed) WHERE ord = first_ord)"""


def near(source: str = "firsts", threshold: str = "0.85") -> str:
    """dropped(ord, leader, similarity) by walking the similar pairs in order."""
    return f"""
  gram AS MATERIALIZED ({grams_of(source)}),
  gram_count AS MATERIALIZED (SELECT ord, count(*) AS n FROM gram GROUP BY ord),
  alike AS MATERIALIZED (
    SELECT lo, hi, shared::DOUBLE / (a.n + b.n - shared)::DOUBLE AS similarity FROM (
      SELECT x.ord AS lo, y.ord AS hi, count(*) AS shared
      FROM (gram JOIN gram_count USING (ord)) x JOIN (gram JOIN gram_count USING (ord)) y
        ON x.g = y.g AND x.ord < y.ord AND x.n >= {threshold} * y.n - 1 AND y.n >= {threshold} * x.n - 1
      GROUP BY x.ord, y.ord)
    JOIN gram_count a ON a.ord = lo JOIN gram_count b ON b.ord = hi
    WHERE shared::DOUBLE / (a.n + b.n - shared)::DOUBLE >= {threshold}::DOUBLE),
  visit AS MATERIALIZED (SELECT row_number() OVER (ORDER BY hi) AS i, hi, list(lo) AS los FROM alike GROUP BY hi),
  walk AS (
    SELECT 0::BIGINT AS i, []::BIGINT[] AS gone
    UNION ALL
    SELECT v.i, CASE WHEN len(list_filter(v.los, lambda x: NOT list_contains(w.gone, x))) > 0 THEN list_append(w.gone, v.hi) ELSE w.gone END
    FROM walk w JOIN visit v ON v.i = w.i + 1),
  gone AS MATERIALIZED (SELECT unnest(gone) AS ord FROM (SELECT gone FROM walk ORDER BY i DESC LIMIT 1)),
  dropped AS MATERIALIZED (
    SELECT hi AS ord, min(lo) AS leader, arg_min(similarity, lo) AS similarity FROM alike
    WHERE hi IN (SELECT ord FROM gone) AND lo NOT IN (SELECT ord FROM gone) GROUP BY hi),
  survivors AS MATERIALIZED (SELECT * FROM {source} WHERE ord NOT IN (SELECT ord FROM gone))"""


def votes(source: str) -> str:
    """(key, simhash) from a relation (key, text)."""
    bits = " + ".join(
        f"(CASE WHEN sum(n * (CASE WHEN (h >> {i}) & 1 = 1 THEN 1 ELSE -1 END)) >= 0 THEN {1 << i if i < 63 else -(1 << 63)}::HUGEINT ELSE 0::HUGEINT END)"
        for i in range(64)
    )
    return f"""
    SELECT s.key, coalesce(v.simhash, -1)::BIGINT AS simhash FROM {source} s LEFT JOIN (
      SELECT key, {bits} AS simhash FROM (
        SELECT key, ('0x' || substr(md5(token), 17, 16))::UBIGINT AS h, n FROM (
          SELECT key, token, count(*) AS n FROM (
            SELECT key, unnest(regexp_extract_all({hash_form('text')}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s\\v\\p{{Z}}]')) AS token FROM {source})
          GROUP BY key, token))
      GROUP BY key) v USING (key)"""


def preview(x: str) -> str:
    c = strip(f"regexp_replace({x}, '{SPACE}+', ' ', 'g')")
    return f"CASE WHEN length({c}) <= 220 THEN {c} ELSE substr({c}, 1, 217) || '...' END"


WITH_DOCS = f"WITH {DOCS}, counted AS MATERIALIZED ({counters_of('docs')})"
NEAR = f"WITH RECURSIVE {RAW_DOCS}, {exact()}, {near()}"
TOKENS_OF_DOCS = f"WITH {DOCS}, counted AS MATERIALIZED (SELECT ord AS doc_id, len(regexp_extract_all(text, '{TOKEN}'))::BIGINT AS token_count FROM docs)"
RAW_TOKENS = f"WITH counted AS (SELECT len(regexp_extract_all(text, '{TOKEN}'))::BIGINT AS token_count FROM documents)"
CLEAN_DOCS = f"WITH {cleaned(corpus=DOCS_CORPUS)}"
SCORED = f"WITH {scored()}"
SCORED_DEFAULT = f"WITH {scored('0.04')}"
SAMPLED_DEFAULT = f"WITH {scored('0.04')}, {CANDIDATES}, {sampled('candidates')}"
SAMPLED = f"WITH {scored()}, {CANDIDATES}, {sampled('candidates')}"
BACKFILL = "(VALUES ('code', 0, 188), ('instruction', 1, 62), ('web', 2, 0)) q(source, place, target)"


def train(min_unique: str, corpus: str | None = None) -> str:
    return f"""WITH RECURSIVE {scored(min_unique, corpus)}, unfiltered AS MATERIALIZED (SELECT * FROM scored WHERE filter_reason = ''), {exact('unfiltered')}, {near()},
  candidates AS MATERIALIZED (SELECT * EXCLUDE (dedup_signature, first_ord) FROM survivors WHERE quality_score >= 0.45), {sampled('candidates')}"""


TRAIN = train("0.0")
NUMBERED = """corpus AS MATERIALIZED (SELECT n AS ord, 'doc_' || CASE WHEN n < 1000000 THEN lpad(n::VARCHAR, 6, '0') ELSE n::VARCHAR END AS id, 'document' AS source,
    text AS raw_text, 'education' AS domain FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM documents))"""
FILES = train("0.0", NUMBERED)
REPORT_CORE = f"""SELECT a AS raw_records, a - f AS kept_records, f AS filtered_records, a - f AS dedup_before, t AS dedup_after,
      round({ratio('(a - f - t)', '(a - f)')}, 6) AS duplicate_rate, t AS train_records, k::BIGINT AS total_tokens FROM
      (SELECT count(*) AS a, count(*) FILTER (filter_reason <> '') AS f FROM scored), (SELECT count(*) AS t, coalesce(sum(token_count), 0) AS k FROM sampled)"""

OTHER_REASON = (
    reason().replace("length < 50 ", "length < 400 ").replace("urls > 10 ", "urls > 1 ").replace("max_run >= 20 ", "max_run >= 8 ").replace(" WHEN flags <> '' THEN 'pii_detected'", "")
)
LARGE = "(VALUES ('web', 0, 21000), ('document', 1, 15000), ('code', 2, 12000), ('instruction', 3, 12000)) q(source, place, target)"

SQL: dict[str, str] = {
    "normalize_text": f"WITH {DOCS} SELECT ord AS doc_id, text FROM docs",
    "text_counters": f"{WITH_DOCS} SELECT ord AS doc_id, * EXCLUDE (ord) FROM counted",
    "detect_language": f"{WITH_DOCS} SELECT ord AS doc_id, {LANGUAGE} AS language FROM counted",
    "pii_flags": f"WITH {DOCS} SELECT ord AS doc_id, {FLAG_TEXT} AS flags FROM docs",
    "filter_reason": f"{CLEAN_DOCS} SELECT id, filter_reason <> '' AS filtered, filter_reason FROM clean",
    "clean_records": f"WITH {cleaned()} SELECT ord, id, source, language, domain, flags, filter_reason, text FROM clean",
    "clean_stats": f"""{CLEAN_DOCS} SELECT count(*) AS input_records, count(*) FILTER (filter_reason = '') AS kept_records,
      count(*) FILTER (filter_reason <> '') AS filtered_records FROM clean""",
    "clean_filter_reasons": f"{CLEAN_DOCS} SELECT filter_reason, count(*) AS records FROM clean WHERE filter_reason <> '' GROUP BY 1",
    "repeated_run": f"WITH {DOCS} SELECT ord AS doc_id, max_run FROM ({runs_of('docs')})",
    "info_unique_ratio": f"""{WITH_DOCS} SELECT ord AS doc_id, round({ratio('alnum', 'visible')}, 6) AS info_ratio,
      round({ratio('"distinct"', 'visible')}, 6) AS unique_ratio FROM counted""",
    "ingest_counts": f"""SELECT 'document' AS source, count(*) AS records FROM documents UNION ALL SELECT 'web', count(*) FROM pages
      UNION ALL SELECT 'instruction', count(*) FROM ({TURNS})""",
    "exact_dedup": f"WITH {RAW_DOCS}, {exact()} SELECT ord, dedup_signature FROM firsts",
    "exact_dedup_stats": f"""WITH {RAW_DOCS}, {exact()} SELECT 'md5_exact' AS method, a AS input_records, b AS output_records, a - b AS duplicates_removed
      FROM (SELECT count(*) AS a FROM signed), (SELECT count(*) AS b FROM firsts)""",
    "exact_duplicates": f"""WITH {RAW_DOCS}, {exact()} SELECT s.ord, s.ord::VARCHAR AS id, f.ord::VARCHAR AS kept_id
      FROM signed s JOIN firsts f USING (dedup_signature) WHERE s.ord > f.ord""",
    "sha1_sig": f"SELECT doc_id AS ord, sha1({hash_form('text')}) AS sha1 FROM documents",
    "char_ngrams": f"""WITH {RAW_DOCS} SELECT ord, count(g)::BIGINT AS grams, md5(coalesce(string_agg(g, '|' ORDER BY g), '')) AS grams_md5
      FROM docs LEFT JOIN ({grams_of('docs')}) USING (ord) GROUP BY ord""",
    "turn_jaccard": f"""WITH pairs AS MATERIALIZED (SELECT {{'c': conv_id, 't': turn}} AS k, question, answer FROM ({PAIRS})),
      a AS MATERIALIZED ({grams_of('pairs', 'question', 'k')}), b AS MATERIALIZED ({grams_of('pairs', 'answer', 'k')}),
      sizes AS (SELECT k, (SELECT count(*) FROM a WHERE a.k = p.k) AS m, (SELECT count(*) FROM b WHERE b.k = p.k) AS n,
        (SELECT count(*) FROM a JOIN b USING (k, g) WHERE a.k = p.k) AS shared FROM pairs p)
      SELECT k.c AS conv_id, k.t AS turn, round(CASE WHEN m + n = 0 THEN 1.0::DOUBLE ELSE shared::DOUBLE / (m + n - shared)::DOUBLE END, 6) AS similarity FROM sizes""",
    "near_dedup": f"{NEAR} SELECT ord, ord::VARCHAR AS record_id, leader::VARCHAR AS duplicate_of, printf('%.4f', similarity)::DOUBLE AS similarity FROM dropped",
    **{f"{name}": f"WITH RECURSIVE {RAW_DOCS}, {exact()}, {near(threshold=t)} SELECT ord, ord::VARCHAR AS record_id, leader::VARCHAR AS duplicate_of, printf('%.4f', similarity)::DOUBLE AS similarity FROM dropped"
       for name, t in (("near_dedup_50", "0.5"), ("near_dedup_70", "0.7"), ("near_dedup_rare", "0.85"), ("minhash_near_dedup_70", "0.7"))},
    "near_dedup_kept": f"{NEAR} SELECT ord, md5(text) AS text_md5 FROM survivors",
    "near_dedup_stats": f"""{NEAR}, ranked AS (SELECT ord, row_number() OVER (ORDER BY ord) AS place FROM survivors)
      SELECT 'char_ngram_jaccard' AS method, (SELECT count(*) FROM firsts) AS input_records, (SELECT count(*) FROM survivors) AS output_records,
        (SELECT count(*) FROM gone) AS duplicates_removed, 0.85::DOUBLE AS threshold, 5::BIGINT AS ngram_size,
        ((SELECT sum(place - 1) FROM ranked) + coalesce((SELECT sum(place) FROM dropped d JOIN ranked r ON r.ord = d.leader), 0))::BIGINT AS comparisons""",
    "minhash_near_dedup": f"{NEAR} SELECT ord, ord::VARCHAR AS record_id, leader::VARCHAR AS duplicate_of, printf('%.4f', similarity)::DOUBLE AS similarity FROM dropped",
    "dedup_rollup": f"""{NEAR} SELECT a AS input_records, b AS output_records, a - b AS duplicates_removed, round({ratio('(a - b)', 'a')}, 6) AS duplicate_rate
      FROM (SELECT count(*) AS a FROM docs), (SELECT count(*) AS b FROM survivors)""",
    "simhash_sig": f"WITH src AS (SELECT doc_id AS key, text FROM documents) SELECT key AS ord, simhash FROM ({votes('src')})",
    "hamming_pairs": f"""WITH src AS (SELECT doc_id AS key, text FROM documents), signed AS MATERIALIZED (SELECT simhash, min(key) AS ord, count(*) AS copies FROM ({votes('src')}) GROUP BY simhash)
      SELECT a.ord AS lo, b.ord AS hi, bit_count(xor(a.simhash, b.simhash))::BIGINT AS distance, a.copies AS lo_copies, b.copies AS hi_copies
      FROM signed a JOIN signed b ON a.ord < b.ord AND bit_count(xor(a.simhash, b.simhash)) <= 3""",
    "turn_hamming": f"""WITH pairs AS MATERIALIZED ({PAIRS}),
      src AS (SELECT {{'c': conv_id, 't': turn, 's': 'q'}} AS key, question AS text FROM pairs UNION ALL SELECT {{'c': conv_id, 't': turn, 's': 'a'}}, answer FROM pairs),
      hashed AS MATERIALIZED ({votes('src')})
      SELECT q.key.c AS conv_id, q.key.t AS turn, bit_count(xor(q.simhash, a.simhash))::BIGINT AS distance
      FROM hashed q JOIN hashed a ON q.key.c = a.key.c AND q.key.t = a.key.t WHERE q.key.s = 'q' AND a.key.s = 'a'""",
    "tokenize": f"WITH {DOCS} SELECT token, count(*) AS occurrences FROM (SELECT unnest(regexp_extract_all(text, '{TOKEN}')) AS token FROM docs) GROUP BY token",
    "tokenize_count": f"{TOKENS_OF_DOCS} SELECT doc_id, token_count, {LENGTH_BUCKET} AS length_bucket FROM counted",
    "token_stats": f"""{RAW_TOKENS} SELECT sum(token_count)::BIGINT AS total_tokens, printf('%.2f', sum(token_count)::DOUBLE / count(*)::DOUBLE)::DOUBLE AS avg_tokens,
      min(token_count) AS min_tokens, max(token_count) AS max_tokens FROM counted""",
    "length_distribution": f"{RAW_TOKENS} SELECT {LENGTH_BUCKET} AS length_bucket, count(*) AS records FROM counted GROUP BY 1",
    "tokens_by_source": f"WITH {CORPUS} SELECT source, sum(len(regexp_extract_all(raw_text, '{TOKEN}')))::BIGINT AS tokens FROM corpus GROUP BY source",
    "tokenizer_fallback": f"""{TOKENS_OF_DOCS} SELECT doc_id, token_count, 'simple_fallback_tokenizer' AS tokenizer, 'no vocabulary on this machine' AS error FROM counted""",
    "pluggable_tokenizer": f"WITH {DOCS} SELECT ord AS doc_id, length(regexp_replace(text, '{SPACE}+', '', 'g'))::BIGINT AS token_count FROM docs",
    "quality_features": f"""{CLEAN_DOCS} SELECT id, token_count, length AS text_length, urls AS url_count, round(repeat_char_ratio, 6) AS repeat_char_ratio,
      flags <> '' AS pii_flag, language, source, round(code_symbol_ratio, 6) AS code_symbol_ratio, round(alpha_digit_ratio, 6) AS alpha_digit_ratio,
      has_instruction_structure FROM ({FEATURES})""",
    "quality_score": f"{SCORED} SELECT ord, source, quality_score, quality_bucket FROM scored",
    "quality_stats": f"{SCORED} SELECT printf('%.4f', sum(quality_score::DECIMAL(18,4))::DOUBLE / count(*)::DOUBLE)::DOUBLE AS avg_score, sum(round(quality_score * 10000)::BIGINT)::BIGINT AS score_sum, min(quality_score) AS min_score, max(quality_score) AS max_score FROM scored",
    "quality_stats_default": f"{SCORED_DEFAULT} SELECT printf('%.4f', sum(quality_score::DECIMAL(18,4))::DOUBLE / count(*)::DOUBLE)::DOUBLE AS avg_score, sum(round(quality_score * 10000)::BIGINT)::BIGINT AS score_sum, min(quality_score) AS min_score, max(quality_score) AS max_score FROM scored",
    "quality_counts": f"""{SCORED} SELECT source, quality_bucket, count(*) AS records FROM scored
      GROUP BY GROUPING SETS ((quality_bucket), (source, quality_bucket))""",
    "sample_by_quality": f"{SCORED}, {CANDIDATES} SELECT ord, quality_score, token_count FROM candidates",
    "sample_by_source_ratio": f"{SAMPLED} SELECT train_rank, ord, source, quality_score, token_count FROM sampled",
    "sample_backfill": f"{SCORED}, {CANDIDATES}, {sampled('candidates', BACKFILL, 250)} SELECT train_rank, ord FROM sampled",
    "sample_large_quotas": f"""WITH {scored()}, {CANDIDATES}, {sampled('candidates', LARGE, 60000)} SELECT train_rank, ord FROM sampled""",
    "sample_topk": f"""{SCORED}, {CANDIDATES} SELECT train_rank::BIGINT AS train_rank, ord FROM (
      SELECT row_number() OVER (ORDER BY {BEST}) AS train_rank, ord FROM candidates) WHERE train_rank <= 100""",
    "source_quotas": f"{SAMPLED} SELECT source, target, available, take, taken_before FROM quota",
    "sampling_metrics": f"""{SAMPLED} SELECT (SELECT count(*) FROM candidates) AS quality_candidates, (SELECT count(*) FROM sampled) AS train_records,
      300::BIGINT AS max_records""",
    "instruction_text": f"WITH {CORPUS} SELECT ord, id, raw_text AS text, parser FROM corpus WHERE source = 'instruction'",
    "html_to_text": f"SELECT page_id, {page_text('html')} AS text FROM pages",
    "parse_corpus": f"""WITH {CORPUS} SELECT ord, id, source, CASE WHEN language IN ('zh','en','mixed','code','unknown') THEN language ELSE 'unknown' END AS language,
      domain, raw_text AS text, extra || 'parser=' || parser || '|title=|url=' || url || '|version=clean_v1' AS metadata FROM corpus""",
    "normalize_records": """SELECT doc_id::VARCHAR AS id, 'unknown' AS source, CASE WHEN lang IN ('zh','en','mixed','code','unknown') THEN lang ELSE 'unknown' END AS language,
      'unknown' AS domain, n_chars AS token_count, 0.0::DOUBLE AS quality_score, '' AS dedup_signature, coalesce(lang, '') AS flags, false AS filtered,
      '' AS filter_reason, '|' || source || '||clean_v1' AS metadata, length(text)::BIGINT AS length FROM documents""",
    "validate_records": """SELECT doc_id, invalid_field = '' AS valid, invalid_field FROM (SELECT doc_id,
      CASE WHEN doc_id % 2 <> 0 AND source NOT IN ('web','document','code','instruction','unknown') THEN 'source'
        WHEN lang NOT IN ('zh','en','mixed','code','unknown') THEN 'language' ELSE '' END AS invalid_field FROM documents)""",
    "jsonl_ingest": """SELECT n AS ord, 'doc_' || CASE WHEN n < 1000000 THEN lpad(n::VARCHAR, 6, '0') ELSE n::VARCHAR END AS id, 'document' AS source,
      CASE WHEN lang IN ('zh','en','mixed','code','unknown') THEN lang ELSE 'unknown' END AS language, md5(text) AS text_md5
      FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM documents)""",
    "source_distribution": f"""{SAMPLED} SELECT source, count(*) AS record_count, sum(token_count)::BIGINT AS token_count,
      printf('%.4f', sum(token_count)::DOUBLE / (SELECT sum(token_count) FROM sampled)::DOUBLE)::DOUBLE AS token_share FROM sampled GROUP BY source""",
    "config_scoping": f"""{CLEAN_DOCS}, other AS MATERIALIZED (SELECT {OTHER_REASON} AS filter_reason FROM clean)
      SELECT 'flat' AS form, filter_reason, count(*) AS records FROM other WHERE filter_reason <> '' GROUP BY 2
      UNION ALL SELECT 'section', filter_reason, count(*) FROM other WHERE filter_reason <> '' GROUP BY 2
      UNION ALL SELECT 'none', filter_reason, count(*) FROM clean WHERE filter_reason <> '' GROUP BY 2""",
    "reason_distribution": f'WITH {cleaned()} SELECT filter_reason, count(*) AS "count" FROM clean WHERE filter_reason <> \'\' GROUP BY 1',
    "quality_distribution": f"""{SCORED} SELECT b AS quality_bucket, count(s.ord) AS "count" FROM (VALUES ('high'), ('medium'), ('low')) v(b)
      LEFT JOIN scored s ON s.quality_bucket = b GROUP BY b""",
    "safety_flag_hist": f"""WITH {cleaned()} SELECT safety_flag, count(*) AS "count" FROM (
      SELECT unnest(string_split(flags, ',')) AS safety_flag FROM clean WHERE flags <> '') GROUP BY 1""",
    "value_counts": 'SELECT lang AS "value", count(*) AS "count" FROM documents GROUP BY lang',
    "top_samples": f"{SAMPLED} SELECT train_rank, source, quality_score, {preview('text')} AS preview FROM sampled ORDER BY quality_score DESC, train_rank LIMIT 3",
    "filtered_samples": f"WITH {cleaned()} SELECT ord, filter_reason, source, {preview('text')} AS preview FROM clean WHERE filter_reason <> '' ORDER BY ord LIMIT 5",
    "report_core": f"{SAMPLED} {REPORT_CORE}",
    "report_core_default": f"{SAMPLED_DEFAULT} {REPORT_CORE}",
    "run_clean": f"WITH {cleaned(corpus=NUMBERED)} SELECT id, source, language, filter_reason, md5(text) AS text_md5 FROM clean",
    "run_pipeline": f"{FILES} SELECT train_rank, source, token_count, quality_score, md5(text) AS text_md5 FROM sampled",
    "run_duplicates": f"""{FILES} SELECT 'exact' AS stage, s.id, f.id AS duplicate_of, 1.0::DOUBLE AS similarity FROM signed s JOIN firsts f USING (dedup_signature) WHERE s.ord > f.ord
      UNION ALL SELECT 'near', a.id, b.id, printf('%.4f', similarity)::DOUBLE FROM dropped d JOIN firsts a ON a.ord = d.ord JOIN firsts b ON b.ord = d.leader""",
    "run_metrics": f"""{FILES}, processed AS MATERIALIZED (SELECT * FROM survivors)
      SELECT 'ingest.records_by_source' AS part, source AS name, count(*) AS value FROM scored GROUP BY 2
      UNION ALL SELECT 'cleaning.filter_reasons', filter_reason, count(*) FROM scored WHERE filter_reason <> '' GROUP BY 2
      UNION ALL SELECT 'tables.filtered_reasons', filter_reason, count(*) FROM scored WHERE filter_reason <> '' GROUP BY 2
      UNION ALL SELECT 'tables.safety_flags', flag, count(*) FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM scored WHERE flags <> '') GROUP BY 2
      UNION ALL SELECT 'tokenizer.token_count_by_source', source, sum(token_count)::BIGINT FROM processed GROUP BY 2
      UNION ALL SELECT 'tokenizer.length_distribution', {LENGTH_BUCKET}, count(*) FROM processed GROUP BY 2
      UNION ALL SELECT 'quality.quality_distribution', quality_bucket, count(*) FROM processed GROUP BY 2
      UNION ALL SELECT 'quality.quality_by_source_bucket', source || ':' || quality_bucket, count(*) FROM processed GROUP BY 2
      UNION ALL SELECT 'tables.source_counts', source, count(*) FROM sampled GROUP BY 2
      UNION ALL SELECT 'tables.source_tokens', source, sum(token_count)::BIGINT FROM sampled GROUP BY 2
      UNION ALL SELECT 'tables.quality_distribution', quality_bucket, count(*) FROM sampled GROUP BY 2
      UNION ALL SELECT 'sampling', 'quality_candidates', count(*) FROM candidates
      UNION ALL SELECT 'sampling', 'train_records', count(*) FROM sampled""",
    "run_core": f"""{FILES} SELECT a AS raw_records, a - f AS kept_records, f AS filtered_records, a - f AS dedup_before, d AS dedup_after,
      round({ratio('(a - f - d)', '(a - f)')}, 6) AS duplicate_rate, t AS train_records, k::BIGINT AS total_tokens FROM
      (SELECT count(*) AS a, count(*) FILTER (filter_reason <> '') AS f FROM scored), (SELECT count(*) AS d, coalesce(sum(token_count), 0) AS k FROM survivors),
      (SELECT count(*) AS t FROM sampled)""",
    "run_report": f"""{FILES} SELECT source, count(*) AS record_count, sum(token_count)::BIGINT AS token_count, 1.0::DOUBLE AS token_share FROM sampled GROUP BY source""",
    "rejected_lines": """SELECT problem, count(*) AS lines FROM (SELECT CASE doc_id % 3 WHEN 0 THEN 'Invalid JSON' WHEN 1 THEN 'JSONL line must be an object' ELSE 'none' END AS problem
      FROM documents) GROUP BY problem""",
    "train_set": f"{TRAIN} SELECT train_rank, ord, source, token_count, quality_score, quality_bucket AS bucket, md5(text) AS text_md5 FROM sampled",
    "train_set_default": f"{train('0.04')} SELECT train_rank, ord, source, token_count, quality_score, quality_bucket AS bucket, md5(text) AS text_md5 FROM sampled",
    "train_set_minhash": f"{TRAIN} SELECT train_rank, ord, source, token_count, quality_score FROM sampled",
}
