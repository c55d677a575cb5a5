import re

import cases
import duckdb
from corpusloom.llm.line_quality import clean_lines
from corpusloom.llm.sql import LINE_QUALITY


def _expected(rows: list[tuple]) -> list[tuple]:
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows: dict[tuple, list[int]] = {}
        for i in range(len(words) - 7):
            windows.setdefault(tuple(words[i : i + 8]), []).append(i)
        repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), base))
    return out


def _got(df) -> list[tuple]:
    return [tuple(r)[:7] for r in df.collect()]


def test_counts_equal_plain_ones(spark):
    rows = cases.texts()
    rng = __import__("random").Random(5)
    rows += [(400 + i, " ".join(rng.choices("abc", k=rng.randint(5, 80))), None) for i in range(60)]
    rows += [(500, "#*$ %& |<> " * 9, None), (501, "once more with feeling and a bit of luck now\n" * 2 + "end", None)]
    assert sorted(_got(clean_lines(cases.table(spark, rows))), key=repr) == sorted(_expected(rows), key=repr)


def _line(spark, text: str):
    return clean_lines(cases.table(spark, [(1, text, None)])).collect()[0]


PROSE = [
    "This is a line of plain prose that says something and ends as prose does, with a full stop.",
    "Another one speaks of rivers and the towns beside them, where markets opened before sunrise!",
    "Would a reader notice that every sentence here was made for a test and nothing else?",
    "THE LAST OF THEM IS WRITTEN IN CAPITALS AND TALKS ABOUT WINTER STORMS ON OPEN WATER.",
]


def test_lines_that_fail_go(spark):
    bad = ["Home | About | Contact | Shop", "no end of a sentence here", "Read more", "All rights reserved.", "a ## b ** c $$ d %% e.", "We use a cookie policy here.", "Start > Shop > Shoes > Red."]
    # Menus that end like sentences, in several languages and of any length.
    bad += ["Home, Search, Contact us.", "Read more…", "Weiter, Zurück: Kontakt.", "Accueil / Connexion / Rechercher.", " > ".join(["shop section"] * 60) + ".", "Search. " * 90]
    bad += ["Alle Rechte vorbehalten.", "© 2020, TOUS DROITS RÉSERVÉS.", "Lea nuestra política de privacidad."]
    row = _line(spark, "\n".join(PROSE[:3] + bad + ["", PROSE[3]]))
    assert row.clean_text == "\n".join(PROSE) and row.lost > 0


def test_documents_that_lose_too_much_go(spark):
    other = [p.rstrip(".!?") for p in PROSE[1:]]
    row = _line(spark, "\n".join([PROSE[0], *other]))
    assert not row.base_failed and row.lost > 0.5 and not row.kept
    assert _line(spark, "\n".join([PROSE[0], "He said: “It is so.”  ", 'She asked: "Why?"\t', "その通り。"])).kept


def test_padded_and_crlf_lines_equal_sql(spark):
    noisy = ["a b # c d #.", "some words | and # more %."]  # 2 symbols in 6 words, 3 in 7: one word fewer fails
    lines = [*PROSE, *noisy, "# a b.", "no end here", "Read more", "Read more, Home.", "ZURÜCK!", "*** three #.", "。", "It is so.)"]
    pads = ["", " " * 60, "\t" * 45, "\r", " \x0b\f\r", "\t \r"]
    texts = [front.join(["", *[line + back + "\n" for line in lines for _ in range(1 + (line in PROSE))]]) for front in ["", "\t", " " * 50, "\x0b "] for back in pads]
    texts += [line + back + "\n" + PROSE[i % 4] for i, line in enumerate(noisy + PROSE) for back in pads]
    texts += ["\t" + line + "\r\n" + own for line in ("# a b.", "a # b c d # e.", "w # v # u t.") for own in ("", "Short one.", PROSE[0])]
    docs = cases.table(spark, [(i, t, None) for i, t in enumerate(texts)])
    want = duckdb.connect()
    want.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    want.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t in enumerate(texts)])
    rows = want.execute(LINE_QUALITY).fetchall()
    got = clean_lines(docs)
    assert sorted(tuple(r) for r in got.drop("clean_text", "lost").collect()) == sorted(rows)
    padded = _line(spark, "\n".join(p + " " * 60 for p in PROSE))
    assert padded.kept and padded.lost == 0


def test_symbols_count_against_words_alone(spark):
    line = "\t# four words now.\r"  # 1 symbol in 4 words passes
    more = "\t# two w.\r"  # 1 symbol in 3 words doesn't, 1 in 4 would
    row = _line(spark, "\n".join([*PROSE, line, more]))
    assert row.clean_text == "\n".join([*PROSE, line])


def test_few_words_or_repeats_fail(spark):
    assert _line(spark, "Only a few words.").base_failed
    row = _line(spark, "one two three four five six seven eight nine ten. " * 5)
    assert row.base_failed and not row.kept and row.n_repeat_words == 50


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert sorted(_got(clean_lines(docs))) == sorted(_expected([(r.doc_id, r.text, r.lang) for r in docs.collect()]))


def test_empty_and_null(spark):
    assert clean_lines(cases.table(spark, [])).collect() == []
    assert {tuple(r) for r in clean_lines(cases.with_nulls(spark)).collect()} == {(None, 0, 0, 0, 0, 0, True, False, 0.0, "")}
