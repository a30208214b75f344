"""Document quality: logistic regression over hashed word n-grams, trained by FTRL-Proximal."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from subscore.llm.text import append_columns, as_bytes, mixed, small_batches

#: Words and runs of other characters.
TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")


@dataclass(frozen=True)
class Settings:
    """Size of the model and of its training.

    ``max_rows`` bounds the labelled rows fitted on: where there are more, a fraction is
    drawn by a hash of the id, so that about ``max_rows`` stay. Scoring has no bound.
    """

    bits: int = 20
    max_rows: int = 12_000
    shards: int = 6
    epochs: int = 4
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.2
    scale: float = 8.0


class _Tokens(dict):
    """Hash of each token, its last 8 bits telling its shape, for a bounded number of tokens."""

    def __init__(self, limit: int = 60_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, token: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        text = token.decode("utf-8", "replace")
        number = xxhash.xxh3_64_intdigest(token)
        if not (text[0].isalnum() or token[0] >= 0x80):
            shape = 16 + number % 240
        elif any(c.isdigit() for c in text):
            shape = 3
        elif len(text) > 1 and text.isupper():
            shape = 2
        elif text[0].isupper():
            shape = 1
        else:
            shape = 0
        value = self[token] = (number & ~0xFF) | shape
        return value


class Features:
    """Buckets of a text's n-grams: words (1 and 2) and shapes of tokens (1 to 3).

    The shape of a token is its case, or the characters themselves where it is punctuation,
    and whether it repeats the token before it.
    """

    def __init__(self, bits: int):
        self.tokens = _Tokens()
        self.mask = np.uint64((1 << bits) - 1)

    def bucket(self, grams: np.ndarray, kind: int) -> np.ndarray:
        return (mixed(grams + np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & self.mask).astype(np.int64)

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        found = TOKENS.findall(text) if text else []
        tokens = np.fromiter(map(self.tokens.__getitem__, found), np.uint64, len(found))
        factor = np.uint64(0xD6E8FEB86659FD93)
        shapes = tokens & np.uint64(0xFF)
        shapes[1:] |= (tokens[1:] == tokens[:-1]).astype(np.uint64) << np.uint64(8)
        pairs = shapes[:-1] * np.uint64(512) + shapes[1:]
        words = [self.bucket(tokens, 1), self.bucket(tokens[:-1] * factor + tokens[1:], 2)]
        forms = [
            self.bucket(shapes, 3),
            self.bucket(pairs, 4),
            self.bucket(pairs[:-1] * np.uint64(512) + shapes[2:], 5),
        ]
        return np.concatenate(words), np.concatenate(forms)

    def sparse(self, text: bytes | None, scale: float) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, values): shares of the n-grams within their kind, times ``scale``."""
        parts = self.of(text)
        buckets = np.concatenate(parts)
        values = np.concatenate([np.full(len(p), scale / max(1, len(p))) for p in parts])
        keys, place = np.unique(buckets, return_inverse=True)
        return keys, np.bincount(place, values, len(keys))


class Ftrl:
    """Follow the regularised leader, per coordinate; the last coordinate is the bias."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros((1 << settings.bits) + 1)
        self.n = np.zeros_like(self.z)

    def weights(self, at) -> np.ndarray:
        s, z = self.s, self.z[at]
        rate = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / rate)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ values))))) - label) * values
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + gradient**2


def in_training(doc_id: str = "doc_id"):
    """Column: true where crc32 of the id's text, modulo 4, is not 2; a missing id counts as true."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 4 != 2, F.lit(True))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
) -> np.ndarray:
    """Weights per bucket, the bias last, learned from the labelled rows of the training part.

    Labels other than 0 and 1 are left out; a repeated label counts as often as it is there.
    The labelled rows, at most about ``settings.max_rows``, are drawn by a hash of their id
    from all of them and dealt over ``shards`` tasks, each of which runs FTRL over its rows;
    the model is the mean of their weights, and what reaches the driver is bounded by the
    number of buckets. Without any usable label all weights are 0 and every score is 0.5.
    """
    small_batches(docs.sparkSession)
    usable = labels.where(F.col(f"`{label}`").isin(0, 1) & F.col(f"`{doc_id}`").isNotNull()).where(
        in_training(doc_id)
    )
    usable = usable.select(F.col(f"`{doc_id}`").alias("~id"), F.col(f"`{label}`").cast("int").alias("~label"))
    rows = usable.count()
    weights = np.zeros((1 << settings.bits) + 1)
    if not rows:
        return weights
    if rows > settings.max_rows:
        share = int(settings.max_rows / rows * (1 << 30))
        usable = usable.where(F.pmod(F.xxhash64(F.lit(10), "~id"), F.lit(1 << 30)) < share)
    # Bounded by max_rows, so small enough to broadcast.
    chosen = docs.select(F.col(f"`{doc_id}`").alias("~id"), F.col(f"`{text}`").alias("~text")).join(
        F.broadcast(usable), "~id"
    )
    dealt = chosen.select(
        F.xxhash64(F.lit(11), "~id").alias("~order"), "~text", "~label"
    ).repartition(settings.shards, "~order").sortWithinPartitions("~order", "~text", "~label")

    def train(batches):
        features, model, rows = Features(settings.bits), Ftrl(settings), []
        bias = np.array([1 << settings.bits])
        for batch in batches:
            for document, mark in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                at, values = features.sparse(document, settings.scale)
                rows.append((np.append(at, bias).astype(np.int32), np.append(values, 1.0), mark))
        for _ in range(settings.epochs):
            for at, values, mark in rows:
                model.learn(at, values, mark)
        if rows:
            at = np.flatnonzero(model.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(model.weights(at)), pa.array(np.full(len(at), len(rows)))],
                names=["bucket", "weight", "rows"],
            )

    learned = dealt.mapInArrow(train, "bucket long, weight double, rows long")
    # Shards count by their rows; the bias is in each of them.
    sums = learned.groupBy("bucket").agg(F.sum(F.col("weight") * F.col("rows")), F.sum("rows")).toArrow()
    if sums.num_rows:
        bucket, weight, seen = (column.to_numpy() for column in sums.columns)
        weights[bucket] = weight / seen.max()
    return weights


def score_quality(
    docs: DataFrame,
    weights: np.ndarray,
    settings: Settings = Settings(),
    text: str = "text",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, from the whole text alone.

    Null and empty texts get the score of the bias. Repeated rows come out as often as they
    came in; an empty table gives an empty table. Columns of ``docs`` (``keep``: only these)
    stay, except that ``score`` replaces a column of this name. The weights (8 bytes for each
    of 2 ** bits buckets) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"weights": weights.astype(np.float32)})

    def prepare():
        w, features = shared.value["weights"], Features(settings.bits)

        def compute(texts):
            margins = np.full(len(texts), float(w[-1]))
            for place, document in enumerate(texts):
                for part in features.of(document):
                    if len(part):
                        margins[place] += settings.scale * float(w[part].sum(dtype=np.float64)) / len(part)
            return (pa.array(1 / (1 + np.exp(-margins.clip(-35, 35)))),)

        return compute

    return append_columns(docs, text, keep, [("score", DoubleType())], prepare)
