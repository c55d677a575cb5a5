import hashlib
import re

import cases
from corpusloom.llm.decontamination import contamination, drop_contaminated


def _words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _expected(rows: list[tuple], items: list[tuple]) -> list[tuple]:
    out = []
    for doc_id, text, _ in rows:
        words = _words(text)
        hit, found = set(), set()
        for item_id, item in items:
            theirs = _words(item)
            n = min(13, len(theirs))
            windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
            for i in range(len(words) - n + 1 if n else 0):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def _got(df) -> list[tuple]:
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()]


def _case():
    rows = cases.texts()
    by_id = {d: t for d, t, _ in rows}
    long = " ".join(by_id[40].split()) if len(by_id[40].split()) > 30 else by_id[207]
    items = [(1, by_id[221]), (2, " ".join(by_id[207].split()[10:40])), (3, "one two"), (4, None), (5, "..."), (None, by_id[203]), (6, "same " * 20), (7, by_id[221]), (8, "no id here but"), (9, long), (10, "z" * 9)]
    for cut in (12, 13, 14):
        rows.append((300 + cut, "Intro words, then: " + " ".join(by_id[207].split()[10 : 10 + cut]) + " and an end", "fr"))
    rows.append((320, " ".join(by_id[207].split()[10:30] + ["gap"] + by_id[207].split()[20:40]), "fr"))
    return rows, items


def test_equals_all_windows(spark):
    rows, items = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(_got(contamination(cases.table(spark, rows), bench)), key=repr) == sorted(_expected(rows, items), key=repr)


def test_random_words_with_many_ties(spark):
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randint(1, 60))), None) for i in range(150)]
    items = [(i, " ".join(rng.choices("ab", k=k))) for i, k in enumerate([1, 3, 5, 8, 9, 12, 13, 13, 14, 20, 30])]
    bench = spark.createDataFrame(items[2:], "item_id long, text string")
    assert sorted(_got(contamination(cases.table(spark, rows), bench)), key=repr) == sorted(_expected(rows, items[2:]), key=repr)


def test_dropped(spark):
    rows, items = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = drop_contaminated(cases.table(spark, rows), bench)
    want = [(d, t) for (d, t, _), e in zip(rows, _expected(rows, items), strict=True) if not e[-1]]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(want, key=repr)
    assert kept.columns == cases.table(spark, rows).columns


def test_empty_and_null(spark):
    rows, items = _case()
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert contamination(cases.table(spark, []), bench).collect() == []
    assert {r.n_hit for r in contamination(cases.table(spark, rows), none).collect()} == {0}
    assert drop_contaminated(cases.table(spark, rows), none).count() == len(rows)
    assert {(r.n_words, r.contaminated) for r in contamination(cases.with_nulls(spark), bench).collect()} == {(0, False)}


def test_items_that_share_a_template(spark):
    template = " ".join(f"w{i}" for i in range(18))
    items = [(i, f"{template} answer{i}") for i in range(40)] + [(40 + i, f"start{i} {template}") for i in range(20)] + [(70, template), (71, template), (72, "w3 w3 w3")]
    texts = [template, f"so {template} answer7 and {template} answer8", " ".join(template.split()[:12]), " ".join(template.split()[4:17]) + " answer3", f"start5 {template}" * 2, "w3 w3 w3 w3 w3", template + " other" * 400]
    rows = [(i, texts[i % len(texts)], None) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = cases.table(spark, rows)
    assert sorted(_got(contamination(docs, bench)), key=repr) == sorted(_expected(rows, items), key=repr)
    assert all(len(r.item_ids) == r.n_items for r in contamination(docs, bench).collect())
