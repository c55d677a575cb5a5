"""Language identification by compression with per-language dictionaries.

A language's dictionary is raw content: words of that language, in mixed order so that no sentence of a learned document can
be matched as a whole.  A text is compressed in blocks with every dictionary; the language whose dictionary gives the
fewest bytes wins.  Blocks are short, so that the dictionary, not the text's own start, is what helps.  Both sides are reduced to letters in lower case.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import column, in_arrow

SAMPLES = 32  # texts that a dictionary is made of, at most
SAMPLE_CHARS = 1_000  # characters of each, at most
BLOCK = 2_048  # bytes compressed at once
LEVEL = 8
MARGIN = 0.002  # of the second-best size; below it a prediction is rejected

MOST_LANGUAGES = 1_000  # that are learned; more of them are an error

_NO_LETTERS = re.compile(r"[\W\d_]+")
_NUMBERS = regex.compile(r"[\p{Nl}\p{No}]")  # count as word characters too: fractions, superscripts, circled and Roman numbers


def letters(text: str) -> str:
    """The text's letters in lower case; anything between them is one space."""
    text = text.lower()
    if not text.isascii():
        text = _NUMBERS.sub(" ", text)
    return _NO_LETTERS.sub(" ", text).strip()


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is 1 modulo 3; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, samples: int = SAMPLES, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A dictionary per language from the documents that aren't held out.

    The bounded sample: documents of a language are dealt by a hash of their id into ``samples`` cells, of each cell the document with the smallest
    hash gives its first ``chars`` characters.  One row per language and cell reaches the driver, of ``MOST_LANGUAGES`` languages at most.  Documents without id,
    language or letters aren't learned from.
    """
    doc_id, text = column("doc_id"), column("text")
    learned = docs.filter(doc_id.isNotNull() & column("lang").isNotNull() & ~held_out(doc_id) & text.rlike(r"\p{L}"))
    order = F.xxhash64(doc_id, text)
    cells = learned.select(column("lang").alias("lang"), F.pmod(F.xxhash64(doc_id, F.lit(1)), F.lit(samples)).alias("cell"), F.struct(order.alias("order"), F.substring(text, 1, chars).alias("text")).alias("one"))
    rows = cells.groupBy("lang", "cell").agg(F.min("one").alias("one")).select("lang", "one.order", "one.text").limit(MOST_LANGUAGES * samples + 1).collect()
    if len(rows) > MOST_LANGUAGES * samples or len({r["lang"] for r in rows}) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    joined: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["order"])):
        joined.setdefault(r["lang"], []).append(r["text"])
    out = {}
    for lang, texts in joined.items():
        words = [w for t in texts for w in letters(t).split()]
        random.Random(1).shuffle(words)
        out[lang] = " ".join(words).encode()
    return out


class Classifier:
    """Predicts with one compressor per language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of the whole text's letters with each dictionary."""
        data = text.encode()
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the margin: how much smaller the best size is than the second best, as a share of it."""
        text = letters(text or "")
        if not text or not self.langs:
            return "und", 0.0
        ranked = sorted(zip(self.sizes(text), self.langs, strict=True))
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        (best, lang), (second, _) = ranked[:2]
        return lang, (second - best) / second


_CLASSIFIERS: dict[int, Classifier] = {}  # of this worker


def _classifier(dictionaries: dict[str, bytes]) -> Classifier:
    name = hash(tuple(sorted(dictionaries.items())))
    if name not in _CLASSIFIERS:
        _CLASSIFIERS.clear()
        _CLASSIFIERS[name] = Classifier(dictionaries)
    return _CLASSIFIERS[name]


def identify(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, accepted.

    Dictionaries come from ``learn_from`` (doc_id, text, lang); see ``fit``.  Predictions use the whole text and nothing else.  lang_pred is the language of the smallest
    size, the first by name of equals; ``und`` if the text is null or has no letter, or nothing was learned.  score is the margin to the second best, 0 to 1 (1 if one
    language was learned); accepted is false for ``und`` and for margins below ``MARGIN``.  Repeated rows get equal
    results; an empty table gives an empty result; other columns are ignored.
    """
    dictionaries = fit(learn_from)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = _classifier(dictionaries)
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column("text")]
            arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score"])

    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), held_out(column("doc_id")).alias("held_out"), column("text").alias("text"))
    found = in_arrow(narrow, step, "doc_id long, held_out boolean, lang_pred string, score double")
    return found.withColumn("accepted", (F.col("lang_pred") != "und") & (F.col("score") >= MARGIN))


def keep_identified(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is predicted with enough margin; all columns stay as they are."""
    dictionaries = fit(learn_from)
    text = docs.columns.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = _classifier(dictionaries)
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column(text)]
            yield batch.filter(pa.array([lang != "und" and score >= MARGIN for lang, score in found], pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever the names hold
    return in_arrow(plain, step, plain.schema).toDF(*docs.columns)
