"""Line-first cleaning: rules per line, failing lines go, documents that lose too much are rejected; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import once
from corpusloom.llm.ngrams import with_run_hashes, word_hashes
from corpusloom.llm.rows import column

_SPACE = r"[\x20\x09-\x0D]+"  # what separates words
_BLANKS = " \t\n\x0b\f\r"  # the same, as characters
_SYMBOLS = "#*$%&|<>"
SPAN = 8  # words of a window whose repeats count

MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words inside of repeated windows

# Line rules.
END_PUNCTUATION = r"[.!?:;,\"')\]”’»…。！？][\x20\x09-\x0D]*$"
_ENTRY = (
    r"(home( ?page)?|next( page)?|previous( page)?|back( to top)?|top|menu|log ?(in|out)|sign ?(in|up|out)|register|search|share|contact( us)?|about( us)?|read more|more|skip to content"
    r"|accueil|suivant|pr[éÉ]c[éÉ]dent|connexion|rechercher|lire la suite|startseite|weiter|zur[üÜ]ck|anmelden|suche|kontakt|[üÜ]ber uns|mehr lesen|weiterlesen"
    r"|inicio|siguiente|anterior|iniciar sesi[óÓ]n|buscar|contacto|leer m[áÁ]s)"
)
_MARKS = r"[\x20\x09-\x0D|>»·•/,;:.!?…-]"
NAVIGATION = rf"(?i)^{_MARKS}*{_ENTRY}({_MARKS}+{_ENTRY})*{_MARKS}*$"  # entries of a menu and marks, nothing else
CRUMBS = r"^([^|>»·•]{1,40}[|>»·•]){2,}[^|>»·•]{0,40}$"  # short pieces between separators
BOILERPLATE = (
    r"(?i)cookie policy|privacy policy|terms of use|terms of service|all rights reserved|enable javascript|uses cookies|lorem ipsum|subscribe to our newsletter"
    r"|politique de confidentialit[éÉ]|mentions l[éÉ]gales|tous droits r[éÉ]serv[éÉ]s|utilise des cookies|datenschutzerkl[äÄ]rung|nutzungsbedingungen|alle rechte vorbehalten"
    r"|verwendet cookies|pol[íÍ]tica de privacidad|t[éÉ]rminos de uso|todos los derechos reservados|utiliza cookies"
)
MAX_SYMBOLS = 0.3  # symbols per word from which a line is no prose
MAX_LOST = 0.5  # share of a document's characters


def words_of(text: Column) -> Column:
    """Maximal runs of characters that aren't ASCII white space; null has none."""
    return F.coalesce(F.filter(F.split(text, _SPACE), lambda w: w != ""), F.array().cast("array<string>"))


def _symbols(text: Column) -> Column:
    rest = text
    for c in _SYMBOLS:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.char_length(text) - F.char_length(rest)


def _passes(line: Column) -> Column:
    """Whether a line with a word is text: it ends like a sentence and is no navigation, boilerplate or run of symbols."""
    bare = F.trim(line, F.lit(_BLANKS))
    noisy = (_symbols(line) > 0) & (_symbols(line) > MAX_SYMBOLS * F.size(F.split(bare, _SPACE)))
    return F.right(bare, F.lit(1)).rlike(END_PUNCTUATION) & ~noisy & ~line.rlike(NAVIGATION) & ~line.rlike(CRUMBS) & ~line.rlike(BOILERPLATE)


def _characters(lines: Column) -> Column:
    return F.char_length(F.array_join(lines, ""))


def _covered(starts: Column) -> Column:
    """How many words the windows at the ascending ``starts`` cover."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct((acc["n"] + s + SPAN - F.greatest(s, acc["upto"])).alias("n"), (s + SPAN).alias("upto")),
        lambda acc: acc["n"],
    )


def _with_repeated(df: DataFrame) -> DataFrame:
    """Replace ``words`` by n_repeat_words, the words inside of 8-word windows found twice or more in the text.

    A window is its words' hash.  Only texts in which a window occurs again sort their windows; neighbours
    of equal hash are then repeats.
    """
    df = once(df, each=word_hashes(F.col("words"))).drop("words")
    df = with_run_hashes(df, "each", SPAN, "windows").drop("each")
    df = once(df, windows=F.when(F.size("windows") >= SPAN, F.slice("windows", 1, F.size("windows") - SPAN + 1)))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = once(df, placed=F.when(again, placed)).drop("windows")
    repeats = F.expr("filter(placed, (p, n) -> p.h = get(placed, n - 1).h OR p.h = get(placed, n + 1).h)")
    starts = F.sort_array(F.transform(repeats, lambda p: p["i"]))
    return once(df, n_repeat_words=F.coalesce(_covered(starts), F.lit(0).cast("long"))).drop("placed")


def clean_lines(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost, clean_text.

    Lines with a word are judged one by one: a line fails if it lacks end punctuation, holds entries of a menu and marks only (punctuated or not), is a row of
    crumbs, holds a boilerplate phrase, or has more than 0.3 symbols per word.  Failing lines go; clean_text joins the
    others with a line feed; lost is the share of the lines' characters that went.  kept is false for a document that
    fails the base rules (under 20 words, or over 30 percent of its words in repeated 8-word windows) or loses over half of its
    characters.  Null, empty and blank texts have no words and fail; their lost is 0 and their clean_text is
    empty.  Repeated rows are judged alike.  An empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(column("text"), F.lit(""))
    df = docs.select(column("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    df = once(df, words=words_of(F.col("text")), lines=F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), n_symbols=_symbols(F.col("text")).cast("long")).drop("text")
    df = once(
        df,
        n_words=F.size("words").cast("long"),
        word_chars=F.char_length(F.array_join("words", "")).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        good=F.filter("lines", _passes),
        all_chars=_characters(F.col("lines")),
    ).drop("lines")
    df = once(df, clean_text=F.array_join("good", "\n"), lost=F.when(F.col("all_chars") > 0, 1 - _characters(F.col("good")) / F.col("all_chars")).otherwise(0.0)).drop("good", "all_chars")
    df = _with_repeated(df)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.col("lost") <= MAX_LOST)).alias("kept"), "lost", "clean_text")
