"""Row-level text functions as Spark column expressions (Python runs on the executors for one of them alone, :func:`char_ngrams_digest`).

All of them take and return :class:`pyspark.sql.Column`.  Where several results share an expensive
input (the visible characters, say), the functions take that input as an argument, so that a caller can
compute it once with :func:`corpusloom.functions.frames.once`.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_nonempty(*cols: Column | str) -> Column:
    """First value that is neither NULL nor the empty string; the empty string if there is none."""
    return F.coalesce(*[F.nullif(col_of(c), F.lit("")) for c in cols], F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace on both ends."""
    return F.btrim(col_of(c), F.lit(P.WS_CHARS))


def compact_whitespace(c: Column | str) -> Column:
    """Blanks to one space, three or more line ends to two, trimmed."""
    v = F.regexp_replace(col_of(c), r"[ \t\r\f\x0B]+", " ")
    return strip(F.regexp_replace(v, r"\n{3,}", "\n\n"))


def normalize_text(c: Column | str) -> Column:
    """Unify line ends, drop control/format characters, collapse blanks and blank lines, trim."""
    v = F.replace(F.coalesce(col_of(c), F.lit("")), F.lit("\r\n"), F.lit("\n"))
    v = F.replace(v, F.lit("\r"), F.lit("\n"))
    v = F.regexp_replace(v, r"[\p{C}&&[^\n\t]]+", "")
    # Form feed and vertical tab are control characters and gone by now.  A lone space and a line end
    # without spaces around are no matches, because there is nothing to change.
    v = F.regexp_replace(v, r"[ \t](?:(?<=\t)|[ \t])[ \t]*", " ")
    v = F.regexp_replace(v, r"[ \n](?:(?<=\n) |(?<= )\n ?)", "\n")
    return strip(F.regexp_replace(v, r"\n{3,}", "\n\n"))


# --- character counters ---------------------------------------------------------------------------


def visible_chars(c: Column | str) -> Column:
    """The text without whitespace."""
    return F.regexp_replace(col_of(c), P.WS + "+", "")


def count_class(visible: Column | str, char_class: str) -> Column:
    """How many characters are in a class: what removing its runs takes away (one match per run)."""
    v = col_of(visible)
    return (F.length(v) - F.length(F.regexp_replace(v, char_class + "+", ""))).cast("bigint")


def count_distinct_chars(visible: Column | str) -> Column:
    v = col_of(visible)
    return F.when(v == "", F.lit(0)).otherwise(F.size(F.array_distinct(F.split(v, "")))).cast("bigint")


def code_keyword_count(c: Column | str) -> Column:
    return F.regexp_count(col_of(c), F.lit(P.CODE_KEYWORD)).cast("bigint")


def url_count(c: Column | str) -> Column:
    return F.regexp_count(col_of(c), F.lit(P.URL)).cast("bigint")


def max_run(c: Column | str) -> Column:
    """Longest run of one non-space character; 0 for the empty text, else at least 1."""
    v = col_of(c)
    runs = F.regexp_extract_all(v, F.lit(r"(?s)(.)\1+"), F.lit(0))
    # Repeated blanks count as one each, like any lone character.
    lengths = F.transform(runs, lambda r: F.when(strip(r) == "", F.lit(1)).otherwise(F.length(r)))
    longest = F.coalesce(F.array_max(lengths), F.lit(1))
    return F.when(v == "", F.lit(0)).otherwise(longest).cast("bigint")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Division that gives 0.0 when the denominator is zero."""
    return F.coalesce(F.try_divide(col_of(part).cast("double"), col_of(whole).cast("double")), F.lit(0.0))


def detect_language(visible: Column, zh: Column, letters: Column, digits: Column, symbols: Column, keywords: Column) -> Column:
    """Language class from character shares; the first matching rule wins."""
    zh_share, en_share, code_share = ratio(zh, visible), ratio(letters, visible), ratio(symbols, visible)
    return (
        F.when(visible == 0, "unknown")
        .when(((code_share > 0.16) & (letters + digits > 8)) | (keywords >= 2), "code")
        .when((zh_share > 0.25) & (en_share > 0.18), "mixed")
        .when(zh_share > 0.3, "zh")
        .when(en_share > 0.5, "en")
        .when((zh_share > 0.08) & (en_share > 0.08), "mixed")
        .otherwise("unknown")
    )


def pii_flags(c: Column | str) -> Column:
    """Array of personal-data and secret flags in fixed order."""
    v = col_of(c)
    found = {
        "email": F.contains(v, F.lit("@")) & v.rlike(P.EMAIL),
        "phone": v.rlike(P.PHONE),
        "id_card": v.rlike(P.ID_CARD),
        "api_key": reduce(Column.__or__, [F.contains(v, F.lit(m)) for m in P.API_KEY_MARKS]) & v.rlike(P.API_KEY),
        "sensitive_keyword": v.rlike(P.SENSITIVE),
    }
    marks = F.array(*[F.when(found[name], name).otherwise("") for name in P.PII_FLAGS])
    return F.array_remove(marks, "")


# --- hashing and sets -----------------------------------------------------------------------------


def hash_form(c: Column | str) -> Column:
    """The form under which two texts count as the same: lower case, trimmed, single spaces."""
    v = strip(F.lower(F.coalesce(col_of(c), F.lit(""))))
    return F.regexp_replace(v, rf"{P.WS}{{2,}}|(?! ){P.WS}", " ")


def gram_form(c: Column | str) -> Column:
    """The hash form without any whitespace; character n-grams are taken from it."""
    return visible_chars(hash_form(c))


def char_ngrams(c: Column | str, n: int = 5) -> Column:
    """Set of character n-grams of a text (given text, not gram form)."""

    def grams(chars: Column) -> Column:
        def at(_: Column, i: Column) -> Column:
            return F.concat(*[F.get(chars, i + k) for k in range(n)])

        return F.array_distinct(F.transform(F.slice(chars, 1, F.size(chars) - (n - 1)), at))

    v = gram_form(c)
    # One-element array + transform binds the split characters once for all positions.
    long_form = F.transform(F.array(F.split(v, "")), grams)[0]
    empty = F.array().cast("array<string>")
    return F.when(v == "", empty).when(F.length(v) <= n, F.array(v)).otherwise(long_form)


def char_ngrams_digest(c: Column | str, n: int = 5) -> Column:
    """Of the set of :func:`char_ngrams`: how many it has (``grams``), and the MD5 of all in order, joined by bars (``grams_md5``).

    An array of strings per text, sorted, costs the JVM ten times as much as the text's own pass; a worker holds one set at a time.
    """

    def digest(texts: pa.Array) -> pa.Array:
        sizes, sums = [], []
        for text in texts:
            v = text.as_py()
            grams = sorted({v[i : i + n] for i in range(max(len(v) - n, 0) + 1)}) if v else []
            sizes.append(len(grams))
            sums.append(hashlib.md5("|".join(grams).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(sums, pa.string())], names=["grams", "grams_md5"])

    return F.arrow_udf(digest, "grams bigint, grams_md5 string")(gram_form(c))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of two sets given as arrays without repeats; two empty sets are alike."""
    a, b = col_of(a), col_of(b)
    every = F.size(a) + F.size(b)
    # A one-element array binds the shared count, so the sets are intersected once.
    shared = F.transform(F.array(F.size(F.array_intersect(a, b)).cast("double")), lambda n: n / (every - n))
    return F.when(every == 0, F.lit(1.0)).otherwise(shared[0])


def token_hash64(token: Column) -> Column:
    """The low 64 bits of a token's MD5, as a BIGINT bit pattern."""
    return F.conv(F.substring(F.md5(token), 17, 16), 16, -10).cast("bigint")


def hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(col_of(a).bitwiseXOR(col_of(b)))


# --- tokens, scores, report helpers -----------------------------------------------------------------


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(col_of(c), F.lit(P.TOKEN), F.lit(0))


def token_count(c: Column | str) -> Column:
    """Size of :func:`tokens`: shrink every longer token to one character, then count the visible ones."""
    return F.length(visible_chars(F.regexp_replace(col_of(c), P.LONG_TOKEN, "x"))).cast("bigint")


def length_bucket(n: Column | str) -> Column:
    n, out = col_of(n), None
    for limit, name in P.LENGTH_BUCKETS[:-1]:
        out = F.when(n <= limit, name) if out is None else out.when(n <= limit, name)
    return out.otherwise(P.LENGTH_BUCKETS[-1][1])


def quality_bucket(score: Column | str) -> Column:
    score, out = col_of(score), None
    for limit, name in P.QUALITY_BUCKETS[:-1]:
        out = F.when(score >= limit, name) if out is None else out.when(score >= limit, name)
    return out.otherwise(P.QUALITY_BUCKETS[-1][1])


def preview(c: Column | str, max_chars: int = 220) -> Column:
    """Whitespace collapsed; longer than the limit is cut and ends in three dots."""
    v = strip(F.regexp_replace(col_of(c), P.WS + "+", " "))
    return F.when(F.length(v) <= max_chars, v).otherwise(F.concat(F.substring(v, 1, max_chars - 3), F.lit("...")))
