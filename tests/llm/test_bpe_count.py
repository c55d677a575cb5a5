import json
import random

import cases
import public_tokenizers
from corpusloom.llm.bpe_count import Counter, byte_symbols, count_tokens, merge_count
from corpusloom.llm.cache import TwoGenerations
from corpusloom.llm.queries import byte_tokenizer
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _library(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_equals_the_library(spark):
    rows = cases.texts()
    got = [tuple(r) for r in count_tokens(cases.table(spark), byte_tokenizer).collect()]
    want = [(d, len((t or "").encode()), n := _library(t or ""), n > 1024) for d, t, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, byte_tokenizer).collect()}
    assert got == {r.doc_id: _library(r.text) for r in docs.collect()}


def test_random_characters():
    counter = Counter(byte_tokenizer())
    rng = random.Random(1)
    spaces = "  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0  ​　"
    letters = "abcXYZ'sdéßж漢😀٣5_-.!?\0́ǅ"
    for _ in range(4000):
        text = "".join(rng.choice(spaces if rng.random() < 0.35 else letters) for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.1:
            text = text.replace("a", "<|endoftext|>")
        assert counter.count(text) == _library(text), repr(text)


def test_merges_of_long_pieces():
    with open(byte_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    counter = Counter(byte_tokenizer())
    rng = random.Random(2)
    for n in (1, 2, 50, 3000):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
        assert merge_count(word.encode(), counter.merges, counter.made) == _library(word)
    assert merge_count(b"", counter.merges, counter.made) == 0 and len(byte_symbols()) == 256 and len(counter.merges) == len(spec["model"]["merges"])


def test_memory_is_bounded():
    made = []
    cache = TwoGenerations(lambda k: made.append(k) or len(k), 3, 4)
    for key in ("a", "b", "c", "a", "d", "a", "e", "f", "g", "a", "toolong"):
        assert cache[key] == len(key)
    assert len(cache) <= 3 and len(cache.old) <= 3 and made.count("a") == 1 and "toolong" not in cache


def test_empty_and_null(spark):
    assert count_tokens(cases.table(spark, []), byte_tokenizer).collect() == []
    assert {tuple(r) for r in count_tokens(cases.with_nulls(spark), byte_tokenizer).collect()} == {(None, 0, 0, False)}
