"""Language identification: averaged hashed subword embeddings.

A text becomes its character n-grams inside words (word ends marked), each
hashed into one of ``2**bits`` rows of an embedding table; the mean of the
rows goes through a linear softmax layer.  Table and layer are trained by
stochastic gradient descent in numpy.  A temperature fitted on sample rows
kept out of training calibrates the probability, and a rejection limit on
it is set so that at most ``max_false_rejects`` of the correct calibration
rows fall below it.

As the layer is linear, the mean of the embeddings times the layer equals
the mean of (embedding times layer); scoring therefore gathers one short
row of logits for each n-gram of a whole text, in blocks of bounded size.

Fitting uses a bounded, documented sample: of each language its first
``sample_rows`` *different* texts by a hash of the text (a rate from the counts
of all rows thins them out before the ranking), of at most ``max_chars``
characters (longer ones are left out, never cut), training folds only.
Every language with such a text is learned; with more than ``max_rows /
sample_rows`` languages each gives fewer texts, about ``max_rows`` in all, but
``LEAST_ROWS`` if it has them, and none gives more than its share of
``max_total_chars`` characters, its first text aside.
Scoring is one scan of every whole text.  With more languages than
dimensions the model keeps the embeddings and the layer apart, so it does
not grow with languages times buckets.

Defined cases: a NULL text or one without a letter is ``und`` with score
0, as is every text where no language could be learned.  Rows with NULL
language teach nothing.  Ids, other columns, repeated rows and the order
of rows do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out

BITS = 16
DIM = 16
ORDERS = (2, 3, 4)
SAMPLE_ROWS = 500
MAX_CHARS = 20_000
MAX_ROWS = 100_000
LEAST_ROWS = 20
MAX_TOTAL_CHARS = 100_000_000
BROADCAST_LANGUAGES = 100_000
EPOCHS = 4
RATE = 0.5
MAX_FALSE_REJECTS = 0.005
BLOCK = 1 << 18
UNKNOWN = "und"

_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logits: np.ndarray  # float32, 2**bits rows: embedding times layer, one column a language; with a layer the embedding
    bias: np.ndarray
    temperature: float
    reject_below: float
    bits: int = BITS
    orders: tuple[int, ...] = ORDERS
    layer: np.ndarray | None = None


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters; every other character is a word end (0)."""
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_letter = (codes >= 97) & (codes <= 122)
    wide = np.flatnonzero(codes >= 128)
    keep = ascii_letter
    if wide.size:
        kinds, where = np.unique(codes[wide], return_inverse=True)
        keep[wide] = np.array([chr(k).isalpha() for k in kinds], dtype=bool)[where]
    return np.concatenate([[np.uint32(0)], np.where(keep, codes, np.uint32(0)), [np.uint32(0)]]).astype(np.uint32)


def ngram_blocks(codes: np.ndarray, bits: int, orders) -> Iterator[np.ndarray]:
    """Buckets of the n-grams that hold no word end inside, in blocks."""
    n = len(codes)
    for s in range(0, n, BLOCK):
        part = codes[s : s + BLOCK + max(orders) - 1]
        here = min(BLOCK, n - s)
        for k in orders:
            m = min(here, len(part) - k + 1)
            if m <= 0:
                continue
            h = np.full(m, np.uint32(k), dtype=np.uint32)
            inner = np.ones(m, dtype=bool)
            some = np.zeros(m, dtype=bool)
            for j in range(k):
                c = part[j : j + m]
                h = (h ^ c) * _MIX[j % 4]
                h ^= h >> np.uint32(15)
                some |= c != 0
                if 0 < j < k - 1:
                    inner &= c != 0
            yield (h[inner & some] >> np.uint32(32 - bits)).astype(np.int64)


def _features(text: str, bits: int, orders) -> tuple[np.ndarray, np.ndarray]:
    got = [b for b in ngram_blocks(code_points(text), bits, orders)]
    rows, times = np.unique(np.concatenate(got) if got else np.empty(0, np.int64), return_counts=True)
    return rows, (times / max(times.sum(), 1)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(
    texts: list[str],
    targets: list[int],
    n_languages: int,
    *,
    bits: int = BITS,
    dim: int = DIM,
    orders=ORDERS,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent; returns (embedding, layer, bias)."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    layer = np.zeros((dim, n_languages), dtype=np.float32)
    bias = np.zeros(n_languages, dtype=np.float32)
    rows = [_features(t, bits, orders) for t in texts]
    y = np.asarray(targets)
    steps, total = 0, max(epochs * len(rows), 1)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, share = rows[i]
            if not idx.size:
                continue
            step = rate * (1 - steps / total)
            steps += 1
            mean = share @ table[idx]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = layer @ p
            layer -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            # the mean spreads the gradient thinly over many rows; a larger step makes up for it
            table[idx] -= (step * 20) * np.outer(share, back)
    return table, layer, bias


def raw_scores(text: str, model: LanguageModel) -> np.ndarray:
    """Logits of one whole text."""
    total, n = np.zeros(model.logits.shape[1]), 0
    for buckets in ngram_blocks(code_points(text), model.bits, model.orders):
        if buckets.size:
            total += np.bincount(buckets, minlength=1 << model.bits) @ model.logits if buckets.size > (
                1 << model.bits
            ) else model.logits[buckets].sum(axis=0, dtype=np.float64)
            n += buckets.size
    mean = total / max(n, 1)
    return (mean if model.layer is None else mean @ model.layer) + model.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss, by a search over a fixed range."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    max_chars: int = MAX_CHARS,
    max_rows: int = MAX_ROWS,
    max_total_chars: int = MAX_TOTAL_CHARS,
    max_false_rejects: float = MAX_FALSE_REJECTS,
) -> LanguageModel | None:
    """Train on rows outside the held-out fold; None if there are none."""
    known = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .where(F.col("lang").isNotNull() & ~held_out(F.col("id")) & (F.length("text") <= max_chars))
        .where(F.col("text").rlike(r"\p{L}"))
        .select("lang", "text", F.xxhash64("text").alias("h"))
    )
    # different texts of each language, to a few hundredths: it only sets the rate of the draw
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    n_languages = counts.count()
    if not n_languages:
        return None
    each = min(sample_rows, max(max_rows // n_languages, LEAST_ROWS))
    share = max_total_chars // n_languages
    rates = counts.select("lang", F.least(F.lit(1.0), F.lit(2.0 * each + 20) / F.col("n")).alias("rate"))
    # the draw needs no shuffle of texts while the table of rates is known to be small
    drawn = (
        known.join(F.broadcast(rates) if n_languages <= BROADCAST_LANGUAGES else rates, "lang")
        .withColumn("place", F.pmod("h", F.lit(1 << 30)))
        .where(F.col("place") < F.col("rate") * float(1 << 30))
        .select("lang", "place", "text")
        .distinct()  # copies are one text, before the shuffle already
    )
    order = Window.partitionBy("lang").orderBy("place", "text")
    first = drawn.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each)
    before = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = first.withColumn("chars", before).where((F.col("chars") <= share) | (F.col("k") == 1)).collect()
    rows.sort(key=lambda r: (r["place"], r["lang"], r["text"]))
    rows = [r for r in rows if has_letter(r["text"])]
    languages = tuple(sorted({r["lang"] for r in rows}))
    if not languages:
        return None
    code = {name: i for i, name in enumerate(languages)}
    texts, y = [r["text"] for r in rows], [code[r["lang"]] for r in rows]
    apart = [i for i in range(len(rows)) if i % 5 == 0] if len(rows) >= 50 else list(range(len(rows)))
    inside = [i for i in range(len(rows)) if len(rows) < 50 or i % 5]
    table, layer, bias = train([texts[i] for i in inside], [y[i] for i in inside], len(languages))
    parts = (table @ layer, None) if len(languages) <= DIM else (table, layer)
    plain = LanguageModel(languages, parts[0], bias, 1.0, 0.0, layer=parts[1])
    z = np.array([raw_scores(texts[i], plain) for i in apart])
    want = np.array([y[i] for i in apart])
    temperature = fit_temperature(z, want)
    p = softmax(z / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == want])
    limit = float(right[int(len(right) * max_false_rejects)]) if right.size else 0.0
    return replace(plain, temperature=temperature, reject_below=limit)


def detect_language(text: Column, model: LanguageModel | None) -> Column:
    """Struct ``(lang_pred, score, rejected)`` of a text column."""

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def detect(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            names, scores, rejected = [], [], []
            for value in batch:
                text = value.as_py()
                if model is None or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                p = softmax(raw_scores(text, model) / model.temperature)
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
                rejected.append(bool(p[best] < model.reject_below))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["lang_pred", "score", "rejected"],
            )

    return detect(text)
