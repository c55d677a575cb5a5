import random
import zlib
from collections import defaultdict

import cases
import public_tokenizers
from corpusloom.llm.packing import STEP, WINDOWS, Ids, cut, pack, regions
from corpusloom.llm.queries import word_tokenizer
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _ids(text: str | None) -> list[int]:
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def _padding(sequences: list[int], window: int) -> float:
    """Sequences are padded to the window, except at a power of two."""
    padded = [n if n & (n - 1) == 0 else window for n in sequences]
    return 1 - sum(sequences) / sum(padded) if padded else 0.0


def _check(rows: list, texts: list[tuple], window: int) -> float:
    """Every id of every document in one piece, every sequence without gap or overlap; the share of padding."""
    want: dict = defaultdict(list)  # documents by id; several may have one
    for doc_id, text in texts:
        want[doc_id].append(_ids(text))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.used, r.window))
    crc = lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    assert set(pieces) == set(want)
    for doc_id, docs in want.items():
        assert sum(n for _, n, _, _ in pieces[doc_id]) == sum(map(len, docs))
        for start, length, its_crc, tokens in pieces[doc_id]:
            assert any(len(ids) == tokens and start + length <= tokens and crc(ids[start : start + length]) == its_crc for ids in docs)
        if len(docs) == 1:
            ends = [(s, s + n) for s, n, _, _ in sorted(pieces[doc_id])]
            assert ends[0][0] == 0 and ends[-1][1] == len(docs[0]) and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for offset, length, used, held in sorted(parts):
            assert offset == at and (used == held or number == len(sequences) - 1) and used <= held <= window
            at += length
        assert at == parts[0][2]
    return _padding([parts[0][2] for parts in sequences.values()], window)


def test_pieces_and_places(spark):
    rows = cases.texts()
    _check(pack(cases.table(spark), word_tokenizer).collect(), [(d, t) for d, t, _ in rows], 4096)
    _check(pack(cases.table(spark), word_tokenizer, windows=(16, 64, 128)).collect(), [(d, t) for d, t, _ in rows], 128)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs, word_tokenizer).collect()
    assert _check(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096) < 0.02
    sizes = {r.sequence_id: (r.window, r.step_id) for r in rows}
    assert {w for w, _ in sizes.values()} == set(WINDOWS)
    groups = defaultdict(list)
    for window, group in sizes.values():
        groups[group].append(window)
    # A group holds sequences of one size, and all hold the same number of tokens but for the last of a size.
    assert all(len(set(g)) == 1 for g in groups.values())
    assert sum(sum(g) != STEP * 4096 for g in groups.values()) <= len(WINDOWS)
    # Short documents share short windows, and those that a window holds are cut once at most.
    assert all(r.window >= r.doc_tokens or r.window >= 2048 for r in rows if r.doc_tokens > 4096)
    pieces = defaultdict(int)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens] += 1
    assert all(n <= 2 for (_, tokens), n in pieces.items() if tokens <= 512)


def test_ids_equal_the_library():
    ids = Ids(word_tokenizer())
    rng = random.Random(4)
    spaces = "  \n\t\r\x0b\x1c\x85\xa0 ​"
    letters = "abcXYZ'sdéßÉİΣσςж漢😀٣5_-.!?\0́ǅ"
    for _ in range(3000):
        text = "".join(rng.choice(spaces if rng.random() < 0.35 else letters) for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.1:
            text = text.replace("a", "<|endoftext|>")
        assert ids.of(text) == b"".join(i.to_bytes(4, "little") for i in _ids(text)[:-1]), repr(text)


def test_padding_of_mixes_with_one_length():
    """A third of the rows with 2,100 tokens, all rows with 2,049, and mixes: hardly any padding, whatever the lengths."""
    rng = random.Random(6)
    mixes = {
        "third, short": [2100] * 10_000 + [rng.randint(20, 200) for _ in range(20_000)],
        "third, longer": [2100] * 10_000 + [rng.randint(20, 1000) for _ in range(20_000)],
        "half windows": [2049] * 30_000,
        "halves of small windows": [257] * 30_000,
        "ones": [1] * 300_000,
    }
    for lengths in mixes.values():
        totals: dict[int, int] = defaultdict(int)
        for n in lengths:
            totals[min(w for w in WINDOWS if w >= n)] += n
        line = regions(totals)
        whole = sum(lengths)
        used = [min(r.window, whole - b) for r in line for b in range(r.begin, r.end, r.window)]
        assert sum(used) == whole and _padding(used, 4096) < 0.02


def test_line_of_windows():
    for seed in range(200):
        rng = random.Random(seed)
        windows = rng.choice([(8,), (4, 16), (2, 4, 8, 16)])
        lengths = [rng.randint(1, rng.choice([3, 16, 40])) for _ in range(rng.randint(0, 60))]
        tier = lambda n, sizes=windows: min((w for w in sizes if w >= n), default=max(sizes))
        lengths.sort(key=lambda n: -tier(n))
        totals: dict[int, int] = defaultdict(int)
        for n in lengths:
            totals[tier(n)] += n
        line, place, held = regions(totals, windows, 2), 0, defaultdict(list)
        for n in lengths:
            found = list(cut(place, n, line, sum(lengths), max(windows), 2))
            assert sum(p[1] for p in found) == n and (len(found) <= 2 or n > min(windows))
            for start, length, sequence, offset, used, window, group in found:
                held[sequence].append((offset, length, used, window, group))
            place += n
        assert sorted(held) == list(range(len(held)))
        for number, parts in held.items():
            assert [o for o, *_ in sorted(parts)] == [sum(n for _, n, *_ in sorted(parts)[:i]) for i in range(len(parts))]
            assert sum(p[1] for p in parts) == parts[0][2] and (parts[0][2] == parts[0][3] or number == len(held) - 1)
        assert [r.window for r in line] == sorted({r.window for r in line}, reverse=True)


def test_smaller_windows_change_the_plan(spark):
    docs = cases.table(spark)
    places = lambda *windows: sorted(repr((r.doc_id, r.start, r.sequence_id, r.offset)) for r in pack(docs, word_tokenizer, windows).collect())
    assert places(512, 4096) != places(4096) and {r.window for r in pack(docs, word_tokenizer).collect()} > {512, 4096}


def test_empty_and_null(spark):
    assert pack(cases.table(spark, []), word_tokenizer).collect() == []
    got = pack(cases.with_nulls(spark), word_tokenizer).collect()
    assert sorted((r.doc_id, r.start, r.length, r.offset, r.sequence_id) for r in got) == [(None, 0, 1, i, 0) for i in range(3)]
