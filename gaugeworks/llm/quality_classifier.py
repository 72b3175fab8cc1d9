"""Quality classifier: zstandard dictionaries of good and bad text.

Two dictionaries are trained, one on good and one on bad labelled texts.
A text is compressed in fixed chunks (so that the dictionary, not the text
seen so far, explains each chunk) once with either; the difference of the
sizes per byte, ``(bad - good) / raw``, says which class the text is made
of.  A logistic curve fitted on labelled texts kept out of the
dictionaries turns the difference into the probability of label 1.

Fitting uses a bounded, documented sample: at most ``sample_rows`` labelled
documents of each class, those with the smallest hash of their id, and
only texts of at most ``max_chars`` characters (longer ones are left out of
the sample, never cut), in the training folds only.  Class shares come from all
labelled rows of these folds.  Scoring is one scan of every whole text and
ships two dictionaries of ``dict_bytes`` bytes.

Defined cases: a NULL, empty or white-space text has difference 0 and the
score of that.  Ids with contradicting labels or NULL labels teach
nothing; repeated label rows count once.  Without two classes to learn
from, every score is the share of label 1 (0.5 without any label).
Columns are chosen by name first, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out

SAMPLE_ROWS = 1500
MAX_CHARS = 20_000
DICT_BYTES = 32 * 1024
CHUNK_BYTES = 1024
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries as bytes (empty: that class was not seen) and the
    logistic curve ``1 / (1 + exp(-(slope * difference + offset)))``."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    chunk_bytes: int = CHUNK_BYTES
    level: int = LEVEL


def build_dictionary(texts: list[bytes], dict_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """A zstandard dictionary; the plain content where there is too little
    text to train one (the trainer wants several times its size)."""
    chunks = [t[i : i + chunk_bytes] for t in texts for i in range(0, len(t), chunk_bytes)]
    size = min(dict_bytes, sum(map(len, chunks)) // 8)
    if len(chunks) >= 16 and size >= 1024:
        try:
            return zstandard.train_dictionary(size, chunks, k=64, d=8).as_bytes()
        except zstandard.ZstdError:
            pass  # e.g. all samples alike
    return b"".join(chunks)[-dict_bytes:]


def _packer(dictionary: bytes, level: int):
    if not dictionary:
        return zstandard.ZstdCompressor(level=level)
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=shared, write_content_size=False, write_dict_id=False)


def size_difference(raw: bytes, good, bad, chunk_bytes: int = CHUNK_BYTES) -> float:
    """Compressed bytes with the bad less those with the good dictionary,
    per byte of text."""
    if not raw.strip():
        return 0.0
    total = 0
    for i in range(0, len(raw), chunk_bytes):
        chunk = raw[i : i + chunk_bytes]
        total += len(bad.compress(chunk)) - len(good.compress(chunk))
    return total / len(raw)


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Weighted logistic regression of one input by Newton's method."""
    scale = float(np.std(x)) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - ridge * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    max_chars: int = MAX_CHARS,
    dict_bytes: int = DICT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    level: int = LEVEL,
) -> QualityModel:
    """Train on the labelled documents outside the held-out fold."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("y").alias("y"), F.max("y").alias("y_max"))
        .where("y = y_max")
        .select("id", "y", F.xxhash64("id").alias("h"))
    )
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    flat = QualityModel(b"", b"", 0.0, float(np.log(prior / (1 - prior))), chunk_bytes, level)
    if len(totals) < 2:
        return flat
    sides = [known.where(F.col("y") == c).orderBy("h", "id").limit(sample_rows) for c in (0, 1)]
    chosen = sides[0].unionByName(sides[1])  # 2 x sample_rows ids: bounded, so it can be broadcast
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") <= max_chars)
    # one text of each id, also where documents repeat an id
    rows = (
        text.join(F.broadcast(chosen), "id")
        .groupBy("h", "id", "y")
        .agg(F.min("text").alias("text"))
        .orderBy("h", "id")
        .collect()
    )
    sample = [(r["y"], r["text"].encode("utf-8")) for r in rows if r["text"].strip()]
    train = {c: [t for i, (y, t) in enumerate(sample) if y == c and i % 4] for c in (0, 1)}
    if not all(train.values()):
        return flat
    good, bad = (build_dictionary(train[c], dict_bytes, chunk_bytes) for c in (1, 0))
    pack_good, pack_bad = _packer(good, level), _packer(bad, level)
    rest = [s for i, s in enumerate(sample) if i % 4 == 0]
    if len({y for y, _ in rest}) < 2:
        rest = sample  # too few rows to keep some apart
    y = np.array([c for c, _ in rest], dtype=float)
    x = np.array([size_difference(t, pack_good, pack_bad, chunk_bytes) for _, t in rest])
    share = {c: totals[c] / sum(totals.values()) for c in (0, 1)}
    w = np.where(y == 1, share[1] / max((y == 1).sum(), 1), share[0] / max((y == 0).sum(), 1)) * len(y)
    slope, offset = fit_logistic(x, y, w)
    return QualityModel(good, bad, slope, offset, chunk_bytes, level)


def quality_score(text: Column, model: QualityModel) -> Column:
    """Struct ``(difference, score)`` of a text column."""

    @F.arrow_udf("difference double, score double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        good, bad = _packer(model.good, model.level), _packer(model.bad, model.level)
        for batch in texts:
            x = np.array(
                [size_difference((v.as_py() or "").encode("utf-8"), good, bad, model.chunk_bytes) for v in batch],
                dtype=float,
            )
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -700, 700)))
            yield pa.StructArray.from_arrays([pa.array(x), pa.array(p)], ["difference", "score"])

    return score(text)


def keep_good(docs: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score ``threshold`` or more; columns as they were."""
    return docs.where(quality_score(F.col(text_col), model)["score"] >= F.lit(threshold))
