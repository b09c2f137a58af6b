"""Language identification by the nearest of several centroids per language.

A text's vector is the TF-IDF of its byte n-grams (one to three, lower case, runs of ASCII characters other than letters
as one blank, hashed to a fixed number of places), with length one. Spherical k-means gives each language several centroids; a text has the language of
the centroid with the largest cosine, and is rejected if even that is farther away than nearly all texts that the
language was learned from.

Defined results: null text and text without a letter give ``und`` and score 0; without labelled rows every text does.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, runs

#: Labelled rows per language that centroids are fitted on, at most.
FIT_ROWS = 1500
PLACES = 1 << 12
CENTROIDS = 4
#: A text is rejected below the cosine that this share of a language's own rows stays below.
REJECT_SHARE = 0.001
ROUNDS = 12
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_SHIFT = 32 - (PLACES.bit_length() - 1)


def counts(text: str | None) -> np.ndarray:
    """Hashed n-gram counts of a whole text."""
    out = np.zeros(PLACES, np.float32)
    data = np.frombuffer(b" ".join((text or "").lower().encode().translate(_LETTERS).split()) + b" ", np.uint8)
    for at in range(0, len(data), 1 << 18):
        b = data[at:at + (1 << 18) + 2].astype(np.uint32)
        n = min(1 << 18, len(data) - at)
        for size, odd in ((1, 2654435761), (2, 2246822519), (3, 3266489917)):
            code = b[:len(b) - size + 1][:n].copy()
            for k in range(1, size):
                code = (code << np.uint32(8)) | b[k:k + len(code)]
            code = (code * np.uint32(odd)) >> np.uint32(_SHIFT)
            out += np.bincount(code, minlength=PLACES)
    return out


def _vectors(texts, idf: np.ndarray) -> np.ndarray:
    x = np.stack([counts(t) for t in texts])
    np.log1p(x, out=x)
    x *= idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from farthest-point starts."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    for _ in range(min(k, len(x)) - 1):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    c = x[chosen]
    for _ in range(rounds):
        of = (x @ c.T).argmax(axis=1)
        new = np.stack([x[of == i].mean(axis=0) if (of == i).any() else c[i] for i in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c):
            break
        c = new
    return c


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]  # of each centroid
    least: np.ndarray  # cosine below which a text is rejected, for each centroid's language


def _fit_language(k: int, reject: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, "f4") for v in rows.sort_values(["h", "vec"]).vec])
        c = _kmeans(x, k)
        least = float(np.quantile((x @ c.T).max(axis=1), reject))
        return pd.DataFrame({"lang": rows.lang.iloc[0], "least": least, "centroid": [v.astype("f4").tobytes() for v in c]})
    return run


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")) \
        .select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h"))


def _frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each n-gram place is found, and the number of texts."""
    def run(batches):
        total, n = np.zeros(PLACES, np.int64), 0
        for batch in batches:
            for _, _, texts in runs(batch.column(0)):
                for text in texts:
                    total += counts(text) > 0
                n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PLACES + 1)), pa.array(np.r_[total, n])], names=["place", "n"])

    found = np.zeros(PLACES + 1, np.int64)
    for r in rows.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        found[r["place"]] = r["n"]  # one row for each place
    return found[:-1], int(found[-1])


def _sample(rows: DataFrame, fit_rows: int) -> DataFrame | None:
    """The first ``fit_rows`` different texts of each language by hash, or all it has; none without a labelled row."""
    labelled = _labelled(rows)
    # different texts, as copies would take the share of the others; one row for each language
    sizes = labelled.select("lang", "h").distinct().groupBy("lang").count().collect()
    if not sizes:
        return None
    # hashes below the limit hold the first fit_rows: eight standard deviations more are expected there
    expected = fit_rows + 8 * math.sqrt(fit_rows) + 32
    limit = {r["lang"]: min((1 << 63) - 1, math.ceil(expected / r["count"] * (1 << 64)) - (1 << 63)) for r in sizes}
    limits = F.create_map(*[x for s, v in limit.items() for x in (F.lit(s), F.lit(v).cast("long"))])
    # copies of a text count once, so that a large group of them neither fills the sample nor meets in one task
    sample = labelled.where(F.col("h") <= limits[F.col("lang")]).dropDuplicates(["lang", "h"])
    return sample.withColumn("n", F.row_number().over(_by_hash())).where(F.col("n") <= fit_rows).drop("n")


def fit(rows: DataFrame, *, fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS, reject: float = REJECT_SHARE) -> Model:
    """Learn from (text, lang) rows: document frequencies from all of them, centroids from at most ``fit_rows`` different
    texts of each language, chosen by hash, whole. What a language's texts become before they meet is of fixed size."""
    sample = _sample(rows, fit_rows)
    if sample is None:
        return Model(np.ones(PLACES, np.float32), np.zeros((0, PLACES), np.float32), [], np.zeros(0))
    found, n = _frequencies(_labelled(rows))
    idf = (np.log((1 + n) / (1 + found)) + 0.1).astype(np.float32)
    vectors = map_texts(sample.select("lang", "h", "text"), lambda texts: [[v.tobytes() for v in _vectors(texts, idf)]],
                        "vec binary", most=256)
    learned = vectors.groupBy("lang").applyInPandas(_fit_language(centroids, reject),
                                                    "lang string, least double, centroid binary").toPandas()
    learned = learned.sort_values(["lang", "centroid"], kind="stable")
    return Model(idf, np.stack([np.frombuffer(c, "f4") for c in learned.centroid]), list(learned.lang),
                 learned.least.to_numpy())


def _by_hash():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy("h", "text")


def predict(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) of every whole text."""
    rows = docs.select(F.col(key).alias("key"), F.when(F.col(text).cast("string").rlike(r"\p{L}"),
                                                       F.col(text).cast("string")).alias("text"))
    handed = docs.sparkSession.sparkContext.broadcast(model)  # bounded: PLACES x centroids x languages

    def run(texts):
        m = handed.value
        names, scores, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        some = [i for i, t in enumerate(texts) if t is not None]
        for at in range(0, len(some), 256) if m.languages else ():
            part = some[at:at + 256]
            near = _vectors([texts[i] for i in part], m.idf) @ m.centroids.T
            best = near.argmax(axis=1)
            for i, b, s in zip(part, best, near[np.arange(len(part)), best]):
                names[i], scores[i] = m.languages[b], float(min(1.0, max(0.0, s)))
                rejected[i] = bool(s < m.least[b])
        return names, scores, rejected

    return map_texts(rows, run, "lang_pred string, score double, rejected boolean")


def held_out(key: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
