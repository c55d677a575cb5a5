"""Small documents that hold every awkward case at once."""

import random

# Columns that clash with names used inside of the operators.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, hash string, part int, words int, fingerprint string"

_STEMS = {"en": "the of and to in that is for with ing tion er ly".split(), "fr": "les des une que pour eau eux ment ois élé ça".split(), "de": "der die und ung sch ein ich ver gen über ß".split()}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = []
    while len(words) < n:
        k = rng.randint(3, 14)
        sentence = ["".join(rng.choices(_STEMS[lang], k=rng.randint(1, 3))) for _ in range(k)]
        sentence[0] = sentence[0].capitalize()
        words += sentence[:-1] + [sentence[-1] + "."]
    out = " ".join(words)
    return "\n".join(out.split(". ", 3)) if n > 60 else out


def texts() -> list[tuple]:
    """(doc_id, text, lang)"""
    rng = random.Random(7)
    docs = [(i, prose(rng, lang := rng.choice(["en", "en", "fr", "de"]), rng.choice([3, 20, 60, 150, 400])), lang) for i in range(60)]
    passage = prose(rng, "en", 70)
    base = docs[5][1]
    docs += [(100 + i, docs[3][1], "en") for i in range(6)]  # copies
    docs += [(120 + i, base + f" Extra{i}.", docs[5][2]) for i in range(5)]  # near copies
    docs += [(140 + i, prose(rng, "en", 60) + "\n" + passage + "\n" + prose(rng, "en", 40), "en") for i in range(5)]
    docs += [
        (200, None, "en"), (201, "", "en"), (202, "  \n\t ", None), (203, "one", "en"), (204, "one two", "de"), (205, "1 2 3 !!! ???", "fr"),
        (206, "same " * 3000, "en"), (207, prose(rng, "fr", 6000), "fr"), (208, "A.\nA.\nA.\n" * 30, "en"), (209, "x" * 5000, "en"),
        (210, "UPPER Case ÀÉÎ İstanbul ǅ ß\x0bvertical\x1cfile space em​zero", "fr"), (211, "a <|endoftext|> b<|startoftext|>c <|endoftext|>", "en"),
        (212, "don't we'll I'M  two   spaces \n \n lines\n\n\nend \t tab ", "en"), (213, "日本語のテキスト 漢字 123 ４５６ 😀😀", "de"), (214, "nul\0byte and more\r\nwindows line\r\n", "en"),
        (None, docs[3][1], "en"), (None, "no id here but words", None), (None, None, None),
        (7, docs[7][1], docs[7][2]), (7, docs[7][1], docs[7][2]), (8, "other text below an id that is taken", "en"), (-5, docs[9][1], "en"), (220, docs[10][1], "xx"),
        (221, passage, "en"), (222, passage + " " + passage, "en"),
    ]
    return docs


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, lang, "src", len(t or ""), "k", 1, "h", 2, 3, "f") for i, t, lang in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(5)


def with_nulls(spark):
    """Rows whose columns are all null."""
    return spark.createDataFrame([(None,) * 11] * 3, COLUMNS)
