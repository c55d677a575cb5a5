import random
import re
import unicodedata
import zlib

import cases
import numpy as np
from corpusloom.llm import substring_dedup
from corpusloom.llm.rows import text_key
from corpusloom.llm.substring_dedup import MIN_WORDS, drop_repeated_sentences, parts, repeated_runs, run_hashes, runs
from pyspark.sql import functions as F

UNSPACED = [(0x0E01, 0x0EFF), (0x0F40, 0x0FBC), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]


def _unspaced(c: str) -> bool:
    return any(a <= ord(c) <= b for a, b in UNSPACED)


def _units(part: str) -> list[str]:
    """The words of a sentence, each with what follows it up to the next one."""
    out, i = [], 0
    while i < len(part):
        begin = i
        if part[i].isspace():
            i += 1
            out[-1:] = [out[-1] + part[begin:i]] if out else [part[begin:i]]
            continue
        if _unspaced(part[i]):
            i += 1
            while i < len(part) and unicodedata.category(part[i])[0] in "MP" and not part[i].isspace():
                i += 1
        else:
            while i < len(part) and not part[i].isspace() and not _unspaced(part[i]):
                i += 1
        out.append(part[begin:i])
    if len(out) > 1 and not out[0].strip():
        out[:2] = [out[0] + out[1]]
    return out


def _sentences(text: str) -> list[str]:
    out, begin, i = [], 0, 0
    full = "\u3002\uff01\uff1f"
    while i < len(text):
        if text[i] == "\n" or (text[i].isspace() and i and text[i - 1] in ".!?" + full) or (i and text[i - 1] in full and text[i] not in full):
            while i < len(text) and text[i].isspace():
                i += 1
            out.append(text[begin:i])
            begin = i
            if i < len(text):
                i += 1
        else:
            i += 1
    return out + [text[begin:]]


def _parts(text: str) -> list[tuple[str, int]]:
    """(part, words): sentences, and long ones cut where a word's hash is the least of seven words in a row."""
    out = []
    for sentence in _sentences(text):
        words = _units(sentence)
        marks = [zlib.crc32(w.strip().lower().encode()) for w in words]
        cuts = {max(range(i, i + 7), key=lambda k: (-marks[k], k)) for i in range(len(words) - 6)} if len(words) > 12 else set()
        held: list[str] = []
        for k, w in enumerate(words):
            if k in cuts and held:
                out.append(("".join(held), len(held)))
                held = []
            held.append(w)
        if held:
            out.append(("".join(held), 0 if not sentence.strip() else len(held)))
    return out


def _runs(words: list[int], least: int) -> set[tuple[int, int]]:
    """Runs that can't begin later, or can't end earlier, and keep enough words."""
    n = len(words)
    sums = [0]
    for w in words:
        sums.append(sums[-1] + w)
    enough = lambda i, j: sums[j + 1] - sums[i] >= least
    out = set()
    for i in range(n):
        if (j := next((j for j in range(i + 1, n) if enough(i, j)), None)) is not None:
            out.add((i, j))
    for j in range(n):
        if (i := next((i for i in range(j - 1, -1, -1) if enough(i, j)), None)) is not None:
            out.add((i, j))
    return out


def _expected(rows: list[tuple], keys: dict, least: int) -> dict:
    docs = sorted({(d, t) for d, t, _ in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, keys[r] >> 32))
    seen, gone = {}, {}
    for d in docs:
        cut = _parts(d[1])
        for first, last in sorted(_runs([n for _, n in cut], least)):
            run = tuple(" ".join(u.strip() for u in _units(p) if u.strip()).lower() for p, _ in cut[first : last + 1])
            if run in seen and seen[run] != (d, first):
                gone.setdefault(d, set()).update(range(first, last + 1))
            seen.setdefault(run, (d, first))
    return {d: "".join(p for i, (p, _) in enumerate(_parts(d[1])) if i not in gone.get(d, ())) for d in docs}


def _compare(spark, rows: list[tuple], least: int = MIN_WORDS) -> list:
    docs = cases.table(spark, rows)
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", text_key(F.col("text")).alias("k")).collect()}
    want = _expected(rows, keys, least)
    got = drop_repeated_sentences(docs, least)
    assert got.columns == docs.columns
    result = got.collect()
    assert sorted([(r.doc_id, r.text) for r in result], key=repr) == sorted([(d, t if t is None else want[d, t]) for d, t, _ in rows], key=repr)
    return result


def _awkward(rng: random.Random, n: int) -> list[str]:
    letters = ["ab .!?\n\t", "ab cd e. ", "abc   .!?\n\t\u3002\u5b57", "a\u00e9 \u00a0\u3000b.\x1c\x85 ", "\u0e01\u0e02 \uff01x."]
    return ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randint(0, 300))) for _ in range(n)]


def test_equals_plain_search(spark):
    rows = cases.texts()
    _compare(spark, rows)
    _compare(spark, rows, least=8)


def test_equals_plain_search_on_scraps(spark):
    """Texts put together from few scraps, with null and repeated ids."""
    rng = random.Random(15)
    scraps = _awkward(rng, 12) + [cases.prose(rng, "en", 60) for _ in range(3)]
    rows = [(rng.choice([None, i, i, 3, 4]), "".join(rng.choice(scraps) for _ in range(rng.randint(0, 6))), None) for i in range(120)]
    _compare(spark, rows + rows[:20], least=12)


def test_parts_equal_a_walk_over_characters():
    rng = random.Random(9)
    for text in [t for _, t, _ in cases.texts() if t is not None] + _awkward(rng, 1500):
        found = parts(text)
        stops = [*found.begins.tolist(), len(text)]
        assert [(text[a:b], n) for a, b, n in zip(stops, stops[1:], np.diff(found.words_before), strict=False)] == _parts(text), repr(text)


def test_runs_equal_definition():
    rng = random.Random(10)
    for _ in range(300):
        docs = [[rng.choice([0, 0, 1, 3, 8, 16, 30]) for _ in range(rng.randint(0, 14))] for _ in range(4)]
        starts = np.cumsum([0, *map(len, docs)])
        first, last = runs(np.cumsum([0, *[w for d in docs for w in d]]), starts, 25)
        found = list(zip(first.tolist(), last.tolist(), strict=True))
        want = {(s + i, s + j) for s, d in zip(starts.tolist(), docs, strict=False) for i, j in _runs(d, 25)}
        assert len(found) == len(set(found)) and set(found) == want, docs


def test_hashes_tell_runs_apart():
    rng = np.random.default_rng(3)
    names = rng.integers(0, 2**64, 6, dtype=np.uint64)
    text = rng.integers(0, 6, 3000)
    first = np.arange(2990)
    last = first + rng.integers(1, 6, 2990)
    found: dict = {}
    for value, a, b in zip(run_hashes(names[text], first, last).tolist(), first, last, strict=True):
        found.setdefault(value, set()).add(tuple(text[a : b + 1]))
    assert all(len(same) == 1 for same in found.values()) and len(found) == len({tuple(text[a : b + 1]) for a, b in zip(first, last, strict=True)})


def test_blocks_do_not_matter(spark, monkeypatch):
    docs = cases.table(spark).repartition(2)
    want = sorted(map(repr, drop_repeated_sentences(docs).collect()))
    for block in (1, 50):
        monkeypatch.setattr(substring_dedup, "BLOCK", block)  # travels to the workers with the step
        assert sorted(map(repr, drop_repeated_sentences(docs.repartition(3)).collect())) == want


def test_passages_of_over_fifty_words_go(spark):
    rng = random.Random(11)
    for longest in (5, 15, 60):
        passage, n = [], 0
        while n <= 50:
            k = rng.randint(min(4, longest), longest)
            passage.append(" ".join(f"w{rng.randint(0, 9999)}" for _ in range(k)).capitalize() + ".")
            n += k
        text = " ".join(passage)
        rows = [(i, f"{cases.prose(rng, 'en', 40)}\n{text}\n{cases.prose(rng, 'en', 40)}", None) for i in range(8)]
        left = {r.doc_id: r.text for r in _compare(spark, rows)}
        assert text in left[0] and not any(p in left[i] for i in range(1, 8) for p in passage if len(p.split()) >= 4)
        assert all(len(left[i].split()) >= 70 for i in range(8))


def test_fifty_words_at_any_offset_go(spark):
    rng = random.Random(12)
    word = lambda: f"w{rng.randint(0, 9999)}"
    rows, planted = [], []
    for k in range(40):  # without sentence ends, and with ends of sentences anywhere
        passage = [word() + ("." if k % 2 and rng.random() < 0.1 else "") for _ in range(50)]
        planted.append(passage)
        for i in range(2):
            rows.append((2 * k + i, " ".join([word() for _ in range(rng.randint(0, 60))] + passage + [word() for _ in range(rng.randint(0, 60))]), None))
    left = {r.doc_id: r.text.split() for r in drop_repeated_sentences(cases.table(spark, rows)).collect()}
    for k, passage in enumerate(planted):
        assert left[2 * k] == rows[2 * k][1].split()
        own = len(rows[2 * k + 1][1].split()) - 50
        assert own <= len(left[2 * k + 1]) <= own + 50 - MIN_WORDS and len(set(passage) & set(left[2 * k + 1])) <= 50 - MIN_WORDS + 2, k


def test_passages_in_scripts_without_spaces_go(spark):
    rng = random.Random(14)
    scripts = [[chr(c) for c in range(0x4E00, 0x5E00)], [chr(c) for c in range(0x0E01, 0x0E2F)], [chr(c) for c in range(0x3042, 0x3094)]]
    text = lambda letters, n: "".join(rng.choice(letters) + (rng.choice("。！？，") if rng.random() < 0.08 and letters is not scripts[1] else "") for _ in range(n))
    rows, passages = [], []
    for k, letters in enumerate(scripts):
        passages.append(text(letters, 90))
        rows += [(10 * k + i, text(letters, 40 + i) + passages[k] + text(letters, 40), None) for i in range(3)]
        rows += [(10 * k + 5 + i, rows[-1][1], None) for i in range(2)]  # exact copies
    left = {r.doc_id: r.text for r in drop_repeated_sentences(cases.table(spark, rows)).collect()}
    for k, passage in enumerate(passages):
        assert left[10 * k] == rows[5 * k][1]
        for i in (1, 2):
            own = len(rows[5 * k + i][1]) - len(passage)
            assert own - 1 <= len(left[10 * k + i]) <= own + 30 and passage[15:70] not in left[10 * k + i]
        assert all(len(left[10 * k + 5 + i]) <= 30 for i in range(2))


def test_hot_run_over_many_partitions(spark):
    text = "This is the first sentence of a hot passage that everyone has. And this is the second of it, which is as long as that one is."
    rows = [(i, f"{text} Own words number {i} follow here.", None) for i in range(700)]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r.text for r in drop_repeated_sentences(cases.table(spark, rows), 20).collect()}
        assert got == {i: (t if i == 0 else f"Own words number {i} follow here.") for i, t, _ in rows}
        assert repeated_runs(cases.table(spark, rows), 20).count() == 699
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_null(spark):
    assert drop_repeated_sentences(cases.table(spark, [])).collect() == []
    assert {tuple(r) for r in drop_repeated_sentences(cases.with_nulls(spark)).collect()} == {(None,) * 11}
