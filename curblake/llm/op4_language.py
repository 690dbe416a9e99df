"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +-1, drawn from its code point.  A trigram a b c is bound into
p(p(a)) * p(b) * c, where p rotates a vector by one place; a text bundles (adds) the vectors of its trigrams,
and a language's prototype bundles those of its training texts, each text with the same weight.  A text gets
the language whose prototype has the largest cosine with it; the cosine, not below 0, is its score.

Texts are bundled where they lie; what comes to the driver is one vector of DIMENSIONS numbers a language,
summed in whole numbers, so that reruns agree.

Runs of characters that aren't letters count as one blank.  A null text and one without a letter get
`und` and 0.  Ties go to the language that sorts first.  Texts are read whole, repeated rows are
scored like any other, and an empty table gives an empty result.  With no training text at all every
text is `und`.  Training takes about SAMPLE texts a language (a documented bound), chosen by a hash of
the id; the score of a text never looks at lang, source or doc_id.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.llm.common import below, give_back, held_out, small_batches

UND = "und"
DIMENSIONS = 1024
#: Training texts a language.
SAMPLE = 1000
#: Weight of a training text, in whole numbers.
SCALE = 1 << 20
#: Letters that a Python worker remembers; trigrams and texts that are bound at once.
LETTERS, GRAMS, TEXTS = 8192, 4096, 128
SEED = 20_240_229

SCORED = "lang_pred string, score double"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point -> code point of its small letter; 0 for what isn't a letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if 0xAC00 <= c < 0xD7A4 or 0x4E00 <= c < 0xA000:
            out[c] = c
        elif (s := chr(c)).isalpha():
            out[c] = ord(low) if len(low := s.lower()) == 1 else c
    return out


def _codes(text: str) -> np.ndarray:
    """Folded letters with single blanks (0) between words and at both ends."""
    letters = _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letters = np.concatenate(([0], letters, [0]))
    return letters[np.concatenate(([True], (letters[1:] != 0) | (letters[:-1] != 0)))]


class Vectors:
    """The letters' vectors, and bundles of texts."""

    def __init__(self, dimensions: int) -> None:
        self.dimensions, self.found = dimensions, {}

    def letters(self, codes: np.ndarray) -> np.ndarray:
        if len(self.found) + len(codes) > LETTERS:
            self.found.clear()
        for c in codes.tolist():
            if c not in self.found:
                self.found[c] = np.random.default_rng([SEED, c]).integers(0, 2, self.dimensions, np.int8) * np.int8(2) - np.int8(1)
        return np.stack([self.found[c] for c in codes.tolist()])

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """One vector a trigram (three code points of 21 bits)."""
        codes, at = np.unique(np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF]), return_inverse=True)
        at, own = at.reshape(3, -1), self.letters(codes)
        return np.roll(own, 2, 1)[at[0]] * np.roll(own, 1, 1)[at[1]] * own[at[2]]

    def bundles(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """The bundle of each text, in whole numbers, and its number of trigrams; 0 for a text without a letter."""
        grams, times, row = [], [], []
        for i, text in enumerate(texts):
            codes = _codes(text).astype(np.int64) if text else ()
            if len(codes) >= 3:
                own, n = np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)
                grams.append(own)
                times.append(n)
                row.append(np.full(len(own), i))
        out, size = np.zeros((len(texts), self.dimensions), np.float64), np.zeros(len(texts), np.int64)
        if grams:
            unique, column = np.unique(np.concatenate(grams), return_inverse=True)
            times, row = np.concatenate(times), np.concatenate(row)
            np.add.at(size, row, times)
            for start in range(0, len(unique), GRAMS):
                here = (column >= start) & (column < start + GRAMS)
                counts = np.zeros((len(texts), min(GRAMS, len(unique) - start)), np.float32)
                counts[row[here], column[here] - start] = times[here]
                out += counts @ self.bind(unique[start : start + GRAMS]).astype(np.float32)
        return out, size


@lru_cache(maxsize=1)
def _vectors(dimensions: int) -> Vectors:
    return Vectors(dimensions)


class Model:
    """The languages' prototypes; a text's score."""

    def __init__(self, langs: list[str], prototypes: np.ndarray) -> None:
        self.langs = langs
        self.prototypes = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list) -> tuple[list[str], list[float]]:
        bundles, size = _vectors(self.prototypes.shape[1]).bundles(texts)
        cosine = bundles @ self.prototypes.T / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-9)
        best = cosine.argmax(1)
        found = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        return [self.langs[b] if s else UND for b, s in zip(best, size, strict=True)], [float(f) if s else 0.0 for f, s in zip(found, size, strict=True)]


@lru_cache(maxsize=1)
def _model(packed: bytes) -> Model:
    return Model(*pickle.loads(packed))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", per_lang: int = SAMPLE, dimensions: int = DIMENSIONS) -> bytes | None:
    """The packed model of all rows of ``docs`` with a lang; bundling is done on the executors."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return None
    rate = F.lit(0.0)
    for name, n in sorted(sizes.items()):
        rate = F.when(F.col(lang) == name, F.lit(min(1.0, per_lang / n))).otherwise(rate)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found, size = _vectors(dimensions).bundles(part["text"].to_pylist())
                for name, v, n in zip(part["lang"].to_pylist(), found, size, strict=True):
                    if n:
                        whole[name] = whole.get(name, 0) + np.rint(v * (SCALE / n)).astype(np.int64)
        give_back()
        for name, v in whole.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)], ["lang", "place", "value"])

    small_batches(docs.sparkSession)
    sample = rows.where(below(rate, key)).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    summed = sample.mapInArrow(bundle, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found = {r["lang"]: r["v"] for r in summed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("v")).collect()}
    if not found:
        return None
    langs = sorted(found)
    return pickle.dumps((langs, np.array([found[n] for n in langs], np.float64) / SCALE))


def predict(docs: DataFrame, model: bytes | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (columns of these names are replaced)."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UND), "score": F.lit(0.0)})

    small_batches(docs.sparkSession)

    @F.pandas_udf(SCORED)
    def run(texts: pd.Series) -> pd.DataFrame:
        m, found = _model(model), ([], [])
        values = texts.tolist()
        for at in range(0, len(values), TEXTS):
            for old, new in zip(found, m.score(values[at : at + TEXTS]), strict=True):
                old.extend(new)
        return pd.DataFrame({"lang_pred": found[0], "score": found[1]})

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "_language")]
    return docs.select(*map(_quoted, kept), run(F.col(text)).alias("_language")).select(*map(_quoted, kept), "_language.*")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def training_rows(docs: DataFrame) -> DataFrame:
    """What may be learned from: rows out of the held-out fold."""
    return docs.where(~held_out())


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    scored = predict(docs.select("doc_id", "text"), train(training_rows(docs)))
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
