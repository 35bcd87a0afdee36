"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every feature of a text counts once: its words, word pairs, and pairs with one word left out,
hashed into a fixed number of coordinates. Each coordinate has its own learning rate, and the
L1 term sets most weights to zero, so that the model is a short list of weights that every
task can hold.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import table

WORD = re.compile(r"\w+")
BITS = 22
KNOWN_WORDS = 500_000
#: Log odds of any text if nothing was learned.
NO_LABELS = -2.2


class Features:
    """Hashed features of a text; words that occur often are hashed once per task."""

    def __init__(self):
        self.words: dict[str, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        known, found = self.words, []
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in WORD.findall(text.lower()):
            code = known.get(word)
            if code is None:
                code = known[word] = zlib.crc32(word.encode(errors="replace"))
            found.append(code)
        return np.array(found, dtype=np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        h = self.hashes(text or "")
        first, second = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        kinds = [h * first]
        if len(h) > 1:
            kinds.append((h[:-1] * first + np.uint64(1)) ^ (h[1:] * second))
        if len(h) > 2:
            kinds.append((h[:-2] * first + np.uint64(2)) ^ (h[2:] * second))
        mixed = np.concatenate(kinds)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Ftrl:
    """``alpha, beta``: learning rate per coordinate; ``l1, l2``: penalties; ``epochs``: passes."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.0
    epochs: int = 5

    def fit(self, texts: list[str], labels: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
        """Coordinates with weight, their weights, and the constant term."""
        features = Features()
        rows = [np.unique(features.of(text)).astype(np.int32) for text in texts]
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        prior = (sum(labels) + 0.5) / (len(labels) + 5)
        bias = float(np.log(prior / (1 - prior)))
        bias_n = 0.0
        for _ in range(self.epochs):
            for x, y in zip(rows, labels, strict=True):
                zx, nx = z[x], n[x]
                w = self.weights(zx, nx)
                g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - y
                root = np.sqrt(nx + g * g)
                z[x] = zx + g - (root - np.sqrt(nx)) / self.alpha * w
                n[x] = nx + g * g
                bias_n += g * g
                bias -= self.alpha / (self.beta + np.sqrt(bias_n)) * g
        w = self.weights(z, n)
        used = np.flatnonzero(w)
        return used, w[used], float(bias)

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def held_out(doc_id: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit_weights(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, model: Ftrl = Ftrl()) -> DataFrame:
    """``coordinate, weight``; coordinate -1 is the constant term.

    Learns from the rows of ``labels(doc_id, toxic)`` that are not held out, at most
    ``max_rows`` of them: the first ones by the hash of doc_id. A document with several labels
    counts as toxic if one of them says so. One task trains on this bounded sample.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id"))
    chosen = (
        usable.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "toxic": []}), *batches])
        rows = rows.assign(at=[zlib.crc32(f"{i:.0f}".encode()) for i in rows.doc_id])
        rows = rows.sort_values(["at", "doc_id"]).drop_duplicates("doc_id")
        used, weights, bias = model.fit(
            [t if isinstance(t, str) else "" for t in rows.text], [int(y > 0) for y in rows.toxic]
        )
        yield pd.DataFrame({"coordinate": [-1, *used], "weight": [bias, *weights]})

    return sample.repartition(1).mapInPandas(train, "coordinate long, weight double")


def score(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= 0.5); own columns of these names go.

    Null and empty texts get the score of a text without features. The weights are at most one
    per coordinate of the hash space, so every task can hold them.
    """
    rows = weights.toPandas()
    # Without any labelled row there is no constant term either: nothing counts as toxic.
    bias = float(rows.loc[rows.coordinate < 0, "weight"].sum()) if (rows.coordinate < 0).any() else NO_LABELS
    kept = rows[rows.coordinate >= 0]
    shared = docs.sparkSession.sparkContext.broadcast(
        (kept.coordinate.to_numpy(dtype=np.int64), kept.weight.to_numpy(dtype=float))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, values = shared.value
        dense = np.zeros(1 << BITS)
        dense[where] = values
        features = Features()
        for batch in batches:
            texts, scores = batch.column("text"), []
            for i in range(len(texts)):
                x = features.of(texts[i].as_py())
                x = np.unique(x[dense[x] != 0])
                scores.append(1 / (1 + np.exp(-np.clip(bias + dense[x].sum(), -35, 35))))
            scores = np.array(scores, dtype=float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    plain = docs.drop("score", "predicted")
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added]))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> DataFrame:
    """Learn from ``labels`` and score every row of ``docs``; see :func:`score`."""
    return score(docs, fit_weights(docs, labels, max_rows))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


QUERIES = {"op10_toxicity": op10_toxicity}
