"""URL filter: rules first, then a character language-model ratio.

Rules ``(verdict, host, path)`` judge the URLs they fit by host and path.
The models read the whole URL as it stands, from the scheme to the end of
query string and fragment.  The URLs with a rule teach two variable-order Markov models of characters, one of accepted and
one of rejected URLs: Witten-Bell smoothing backs a context of ``order``
characters off to shorter ones, down to the uniform distribution, so an
unseen context simply uses the longest one that was seen.  All other URLs
are judged by the difference of the log-likelihoods per character: allowed
at or above a limit, blocked below.  The limit is the one that errs least
on rule-judged URLs kept out of the counts (a fifth, by a hash of the URL),
each class weighing the same.

Counts and the calibration histogram are Spark aggregations over every
rule-judged URL; counts are summed before the shuffle.  Characters are
folded into ``SYMBOLS``, so a model has at most ``len(SYMBOLS) ** (order +
1)`` cells however large the table: this bounds what the driver gathers
and broadcasts (25 MB at order 3).

Defined cases: a URL without ``://`` has empty host and path and no rule,
and is judged by the models like any other; a NULL or empty one has ratio 0
and is blocked: there is nothing to accept.  If one
class has no URLs, all ratios are 0 and URLs without a rule are allowed.
Repeated rows and NULL ids are judged like any other; of several fitting
rules the longest wins, then the earlier in the list; an empty table gives
an empty result.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that count apart; any other is one more, the start another.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789./-_?=&#%:~+"
ORDER = 3
_SIZE = len(SYMBOLS) + 2
_OTHER, _START = len(SYMBOLS), len(SYMBOLS) + 1
BINS, SPAN = 4001, 10.0

Rule = tuple[str, str, str]


def split_rule(verdict: str, text: str) -> Rule:
    """``("allow", "example.org/es/")`` to (verdict, host, path)."""
    host, slash, path = text.partition("/")
    return verdict, host, slash + path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z in lower case; empty without one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct (verdict, rule), or NULL."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True)[::-1]:
        fits = (host == F.lit(rule_host)) | host.endswith("." + rule_host)
        found = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        out = F.when(fits & path.startswith(rule_path), found).otherwise(out)
    return out


def _codes() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.int64)
    for i, c in enumerate(SYMBOLS):
        table[ord(c)] = i
        table[ord(c.upper())] = i
    return table


def context_keys(text: str, order: int, codes: np.ndarray) -> np.ndarray:
    """(context, next character) of each byte as one number."""
    raw = codes[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)]
    padded = np.concatenate([np.full(order, _START, dtype=np.int64), raw])
    key = np.zeros(len(raw), dtype=np.int64)
    for k in range(order + 1):
        key = key * _SIZE + padded[k : k + len(raw)]
    return key


def log_probabilities(counts: np.ndarray, order: int) -> np.ndarray:
    """Witten-Bell estimates for every full context, from the counts of
    (context, next) cells."""
    table = counts.reshape((_SIZE,) * (order + 1))
    p = np.full(_SIZE, 1.0 / _SIZE, dtype=np.float32)
    for k in range(order + 1):  # contexts of 0, 1, ... characters
        n = table.sum(axis=tuple(range(order - k))) if k < order else table
        seen = n.sum(axis=-1, keepdims=True, dtype=np.float32)
        kinds = (n > 0).sum(axis=-1, keepdims=True, dtype=np.float32)
        lower = np.broadcast_to(p, n.shape)
        p = np.where(seen > 0, (n + kinds * lower) / np.maximum(seen + kinds, 1), lower).astype(np.float32)
    return np.log(p).ravel()


def fit(judged: DataFrame, order: int = ORDER) -> tuple[np.ndarray | None, float]:
    """Log-ratio of each (context, next) cell and the limit, from rows
    ``(text, accepted boolean)``; ``(None, 0.0)`` without both classes."""
    apart = F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(5)) == 0
    judged = judged.where(F.length("text") > 0)
    codes = _codes()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            texts = batch.column(0).to_pylist()
            for accepted in (False, True):
                got = [context_keys(t, order, codes) for t, s in zip(texts, side) if s == accepted]
                if got:
                    keys, n = np.unique(np.concatenate(got), return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {"accepted": pa.array([accepted] * len(keys)), "cell": keys, "n": n.astype(np.int64)}
                    )

    counted = (
        judged.where(~apart)
        .mapInArrow(cells, "accepted boolean, cell bigint, n bigint")
        .groupBy("accepted", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # at most _SIZE ** (order + 1) rows a class
    )
    side = counted["accepted"].to_numpy().astype(bool)
    cell, n = counted["cell"].to_numpy(), counted["n"].to_numpy()
    if side.all() or not side.any():
        return None, 0.0
    logs = []
    for accepted in (True, False):
        dense = np.zeros(_SIZE ** (order + 1), dtype=np.float32)
        dense[cell[side == accepted]] = n[side == accepted]
        logs.append(log_probabilities(dense, order))
    ratio = logs[0] - logs[1]

    x = F.least(F.greatest(F.round((log_ratio(F.col("text"), ratio, order, judged) + SPAN) / (2 * SPAN) * (BINS - 1)), F.lit(0)), F.lit(BINS - 1))
    held = judged.where(apart).select("accepted", x.cast("int").alias("bin")).groupBy("accepted", "bin").count().toArrow()
    hist = np.zeros((2, BINS))
    for a, b, k in zip(*(held[c].to_pylist() for c in ("accepted", "bin", "count"))):
        hist[int(a), b] = k
    return ratio, limit_of_least_error(hist)


def limit_of_least_error(hist: np.ndarray) -> float:
    """``hist``: rejected and accepted rows by bin.  Between equally good
    limits, the middle of the range around 0 or next to it."""
    total = hist.sum(axis=1)
    if not total.all():
        return 0.0
    share = np.concatenate([[[0.0], [0.0]], np.cumsum(hist / total[:, None], axis=1)], axis=1)
    error = np.round(share[1] + 1 - share[0], 12)  # accepted below the limit, rejected at or above
    best = np.flatnonzero(error == error.min())
    edges = (best - 0.5) / (BINS - 1) * 2 * SPAN - SPAN
    runs = np.split(edges, np.flatnonzero(np.diff(best) > 1) + 1)
    run = min(runs, key=lambda r: 0 if r[0] <= 0 <= r[-1] else min(abs(r[0]), abs(r[-1])))
    return float((run[0] + run[-1]) / 2)


def log_ratio(text: Column, ratio: np.ndarray | None, order: int, df: DataFrame) -> Column:
    """Mean log-likelihood ratio per character; 0 for the empty text."""
    shared = None if ratio is None else df.sparkSession.sparkContext.broadcast(ratio)
    codes = _codes()

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = np.zeros(len(batch))
            if shared is not None:
                table = shared.value
                for i, t in enumerate(batch.to_pylist()):
                    if t:
                        out[i] = table[context_keys(t, order, codes)].mean(dtype=np.float64)
            yield pa.array(out)

    return score(text)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, log_ratio, limit``."""
    url = F.col("url")
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).select(
        "page_id",
        F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(path_of(url), F.lit("")).alias("path"),
        F.coalesce(url, F.lit("")).alias("text"),
    )
    found = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    judged = found.where("found is not null").select("text", (F.col("found.verdict") == "allow").alias("accepted"))
    ratio, limit = fit(judged, order)
    method = F.when((F.length("text") > 0) & (F.col("log_ratio") >= F.lit(limit)), "allow").otherwise("block")
    return found.withColumn("log_ratio", log_ratio(F.col("text"), ratio, order, pages)).select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), method).alias("verdict"),
        "log_ratio",
        F.lit(limit).alias("limit"),
    )
