"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is cut into pieces of PIECE bytes, so that the dictionaries, not the text's own repetitions,
decide.  Each piece is compressed with either dictionary; the feature is the difference of the total
sizes over their sum.  A logistic curve, fitted on labelled texts that the dictionaries haven't seen,
turns it into the probability of label 1.

Null and empty texts have a difference of 0 and get the curve's value there.  If a class has no
labelled text, every score is the share of label 1 among the labelled (0.5 without any).  Labels null
or other than 0 and 1 are not learned from; a document with both labels counts as 1.  Texts are scored
whole; repeated rows are scored like any other.  The classifier is fitted on DICTIONARY + CALIBRATION
texts of each class at most, none over LONGEST characters (documented bounds), chosen by a hash of the id.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curblake.llm.common import by_batch, held_out

PIECE = 512
LEVEL = 3
DICTIONARY_BYTES = 112_640
#: Labelled texts of a class: for its dictionary, and for the curve.
DICTIONARY = 800
CALIBRATION = 800
#: Longest text to learn from, so that what comes to the driver is bounded.
LONGEST = 32_768
#: Score from which `predicted` is 1.
THRESHOLD = 0.3

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def _pieces(text: str | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if text else b""
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def _dictionary(texts: list[str]) -> bytes:
    import zstandard

    pieces = [p for t in texts for p in _pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(pieces)[-DICTIONARY_BYTES:]


class Model:
    def __init__(self, bad: bytes, good: bytes, curve: tuple[float, ...]) -> None:
        import zstandard

        def compressor(data: bytes):  # noqa: ANN202
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress

        self.bad, self.good, self.curve = compressor(bad), compressor(good), curve

    def features(self, text: str | None) -> tuple[float, float]:
        pieces = _pieces(text)
        bad, good = sum(map(len, map(self.bad, pieces))), sum(map(len, map(self.good, pieces)))
        gap = (bad - good) / max(1, bad + good)
        return gap, gap * min(1.0, np.log1p(len(pieces)) / 3)

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -30, 30))))


def _fit(rows: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, ...]:
    """Logistic curve by Newton steps; classes weigh as in all labelled rows, with a weak ridge."""
    x = np.column_stack([np.ones(len(rows)), rows])
    weight = np.where(labels == 1, share / max(1, (labels == 1).sum()), (1 - share) / max(1, (labels == 0).sum())) * len(labels)
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[1e-4] * rows.shape[1]])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (labels - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, beta))


@lru_cache(maxsize=1)
def _model(packed: bytes) -> Model:
    return Model(*pickle.loads(packed))


def train(docs: DataFrame, labels: DataFrame, dictionary: int = DICTIONARY, calibration: int = CALIBRATION) -> tuple[bytes | None, float]:
    """The packed model (None if a class is missing) and the share of label 1."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    if len(sizes) < 2:
        return None, share
    hashed = known.withColumn("_h", F.xxhash64("doc_id"))
    some = [hashed.where(F.col("quality") == q).orderBy("_h", "doc_id").limit(dictionary + calibration) for q in (0, 1)]
    # at most 2 x (dictionary + calibration) rows, so a broadcast is safe at any size
    texts = docs.select("doc_id", "text").where(F.length("text") <= LONGEST).join(F.broadcast(some[0].unionByName(some[1])), "doc_id").groupBy("doc_id", "quality", "_h").agg(F.max("text").alias("text"))
    by_class: dict[int, list[str]] = {0: [], 1: []}
    for r in sorted(texts.collect(), key=lambda r: (r["_h"], r["doc_id"])):
        if r["text"]:
            by_class[r["quality"]].append(r["text"])
    if not all(by_class.values()):
        return None, share
    split = {q: max(1, len(t) * dictionary // (dictionary + calibration)) for q, t in by_class.items()}
    bad, good = (_dictionary(by_class[q][: split[q]]) for q in (0, 1))
    probe = Model(bad, good, (0.0, 0.0, 0.0))
    rest = [(t, q) for q, ts in by_class.items() for t in (ts[split[q] :] or ts)]
    curve = _fit(np.array([probe.features(t) for t, _ in rest]), np.array([q for _, q in rest]), share)
    return pickle.dumps((bad, good, curve)), share


def score(docs: DataFrame, model: tuple[bytes | None, float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; one pass, no shuffle."""
    packed, share = model

    def run(ids: list, folds: list, texts: list) -> list:
        scores = [_model(packed).score(t) for t in texts] if packed else [share] * len(texts)
        return [ids, folds, scores, [int(s >= threshold) for s in scores]]

    return by_batch(docs.select("doc_id", held_out().alias("held_out"), "text"), SCHEMA, run, "doc_id", "held_out", "text")
