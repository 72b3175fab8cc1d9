"""Approximate nearest neighbours: cross-polytope hashing.

Vectors are scaled to unit length and turned by pseudo-rotations (three
rounds of random signs and a fast Hadamard transform, on the dimension
padded to a power of two); the bucket of a vector in a table is the signed
axis nearest to the turned vector.  ``TABLES`` independent rotations give as many
tables.  A query looks into the ``PROBES`` buckets of each table whose
axes are nearest to it (multiprobe) and ranks all vectors found there by
their cosine in double precision.

Rows with equal vectors are one class: a class is hashed and scored once
and holds its ``k + 1`` smallest ids, which is all that any answer can
use, so a vector that fills a third of the table is one row.  A bucket
holds on average one in ``2 * dimension`` of the vectors; it is cut into
blocks of about ``BLOCK`` vectors, and queries meet a block as one matrix
product.  Only the ``k + 1`` best ids of a query leave a block, by cosine
and then by id over all classes tied at the cut, so candidate pairs are
never rows.

Queries that found fewer than ``k`` are searched exactly, against all
vectors in blocks.  Every vector of the table is indexed and nothing is fitted
to the data.  ``RECALL`` notes the recall that was measured.

Defined cases: vectors that are NULL, empty, zero or hold NULL or
non-finite components take no part, neither do rows with NULL ids; rows
with equal id and vector count once.  Vectors of different dimension never meet.  An id
is never its own neighbour, also where it occurs with several vectors; each
of these is a query of its own then.  Cosines are ordered rounded to ``DIGITS``
digits, so scaled copies tie, and returned as they are; ties go to the
smaller id; fewer than ``k`` others give all of them.  Only the two named columns are read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TABLES = 10
PROBES = 10
BLOCK = 4096
K = 5
SEED = 23
#: Share of the true 5 nearest found, against brute force: check_s, and more on check_l (README).
RECALL = 0.985

#: Cosines that are equal when rounded to so many digits are ties.
DIGITS = 12
#: What the product of unit vectors and the cosine, or two ties, can differ by.
TIE = 2e-12

_RESULT = "q string, vec_id bigint, score double, exact double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, length kept."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    d = 1 << max(x.shape[1] - 1, 0).bit_length()
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    signs = np.random.default_rng([seed, table, d]).choice([-1.0, 1.0], (3, d))
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(x: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first: axis
    ``i`` is bucket ``2 i``, its opposite ``2 i + 1``."""
    y = rotate(x, table)
    signed = np.stack([y, -y], axis=2).reshape(len(y), -1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def _unit(rows: pa.Array) -> np.ndarray:
    x = np.array(rows.to_pylist(), dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def _valid(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def _bucket_rows(df: DataFrame, probes: int) -> DataFrame:
    """``key`` and the columns of ``df``, of which the first are ``cls`` and
    ``v``, for each table and probed bucket of each class."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(1)])
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                x = _unit(part.column(1))
                for t in range(TABLES):
                    b = buckets(x, t, probes)
                    take = np.repeat(np.arange(len(b)), b.shape[1])
                    keys = [f"{d}:{t}:{k}" for k in b.ravel()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), *(c.take(pa.array(take)) for c in part.columns)], names=["key", *part.schema.names]
                    )

    return df.mapInArrow(hashed, "key string, " + ", ".join(f"{n} {t}" for n, t in df.dtypes))


def _candidates(s: np.ndarray, ids: list[np.ndarray], single: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, class) of a score matrix that hold the ``k`` best ids of
    every row, by score, then id; an id counts once, at its best score.
    ``single`` is the number of ids of a class that no other class has."""
    n = s.shape[1]
    some = min(n, 2 * k)
    at = np.argpartition(-s, some - 1, axis=1)[:, :some]
    top = np.take_along_axis(s, at, axis=1)
    order = np.argsort(-top, axis=1, kind="stable")
    at, top = np.take_along_axis(at, order, axis=1), np.take_along_axis(top, order, axis=1)
    full = np.cumsum(single[at], axis=1) >= k
    cut = np.where(full.any(axis=1), top[np.arange(len(s)), full.argmax(axis=1)], -np.inf) - TIE
    # what stayed outside scores at most the last of the inside
    easy = (cut > top[:, -1] + TIE) | (some == n)
    rows, places = np.nonzero((top >= cut[:, None]) & easy[:, None])
    out = [(rows, at[rows, places])]
    for i in np.flatnonzero(~easy):
        order, seen, take = np.argsort(-s[i], kind="stable"), set(), []
        for c in order.tolist():
            fresh = [x for x in ids[c] if x not in seen]
            if fresh:
                take.append(c)
                seen.update(fresh)
            if len(seen) >= k:
                break
        # of the classes at the cut, those with the smallest ids
        tied = np.flatnonzero(np.abs(s[i] - s[i, take[-1]]) <= TIE)
        whose = np.repeat(tied, [len(ids[c]) for c in tied])
        _, first = np.unique(np.concatenate([ids[c] for c in tied]), return_index=True)
        # an id counts for the cut only where no class above it has it
        above = [c for c in take if s[i, c] > s[i, take[-1]] + TIE]
        known = {x for c in above for x in ids[c].tolist()}
        flat = np.concatenate([ids[c] for c in tied])
        first = [f for f in first.tolist() if int(flat[f]) not in known][:k]
        chosen = np.unique(np.array(above + whose[first].tolist(), dtype=np.int64))
        out.append((np.full(len(chosen), i), chosen))
    return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])


def _best_ids(row: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best distinct ids of each row, by score, then id."""
    order = np.lexsort((-score, vec_id, row))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (row[order][1:] != row[order][:-1]) | (vec_id[order][1:] != vec_id[order][:-1])
    order = order[fresh]
    order = order[np.lexsort((vec_id[order], -score[order], row[order]))]
    begins = np.flatnonzero(np.diff(row[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(begins, append=len(order)))
    return order[rank < k]


def _best_in_blocks(queries: DataFrame, data: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``q, vec_id, score, exact`` (the cosine, rounded and not): for each
    query the ``k`` best ids of each block of its keys.  Both sides have ``key, cls, v``, the data ``ids`` too; a
    key with many rows is cut into blocks on either side, and each pair of
    blocks is one product."""
    sizes = (
        data.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", F.ceil(F.col("n") / F.lit(block)).alias("parts"))
    )
    asked = (
        queries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).select("key", F.ceil(F.col("m") / F.lit(block)).alias("asks"))
    )
    plan = sizes.join(asked, "key")  # keys without queries go
    right = (
        data.join(plan, "key")
        .withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")))
        .withColumn("ask", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("asks") - 1)))
        .select("key", "part", "ask", "ids", "v")
    )
    left = (
        queries.join(plan, "key")
        .withColumn("ask", F.pmod(F.xxhash64("cls"), F.col("asks")))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select("key", "part", "ask", "cls", "v")
    )

    def best(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not ours.num_rows or not theirs.num_rows:
            none = pa.array([], pa.float64())
            return pa.table({"q": pa.array([], pa.string()), "vec_id": pa.array([], pa.int64()), "score": none, "exact": none})
        v, w = (np.array(t["v"].to_pylist(), dtype=np.float64) for t in (ours, theirs))
        x, y = _unit(ours["v"]), _unit(theirs["v"])
        ids = [np.array(i, dtype=np.int64) for i in theirs["ids"].to_pylist()]
        sizes = np.array([len(i) for i in ids])
        flat, begins = np.concatenate(ids), np.cumsum(sizes) - sizes
        _, where, times = np.unique(flat, return_inverse=True, return_counts=True)
        single = np.add.reduceat((times[where] == 1).astype(np.int64), begins)
        out = []
        for i in range(0, len(x), 512):
            row, c = _candidates(x[i : i + 512] @ y.T, ids, single, k)
            exact = cosine(v[row + i], w[c])
            score = np.round(exact, DIGITS) + 0.0
            each = np.repeat(np.arange(len(c)), sizes[c])
            nth = np.arange(len(each)) - np.repeat(np.cumsum(sizes[c]) - sizes[c], sizes[c])
            found = flat[begins[c][each] + nth]
            keep = _best_ids(row[each], found, score[each], k)
            out.append((row[each][keep] + i, found[keep], score[each][keep], exact[each][keep]))
        row, found, score, exact = (np.concatenate(o) for o in zip(*out))
        q = ours["cls"].take(pa.array(row))
        return pa.table({"q": q, "vec_id": pa.array(found), "score": pa.array(score), "exact": pa.array(exact)})

    keys = ["key", "part", "ask"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda ours, theirs: best(ours, theirs), _RESULT
    )


def nearest(
    vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found to each
    row for which ``is_query`` (a condition on the id, named ``vec_id``)."""
    rows = (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & _valid(F.col("v")))
        .withColumn("asks", is_query)
    )
    # the k + 1 smallest ids of each vector, repeated rows counted once; Spark cuts groups before the shuffle
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.select("vec_id", "v").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    classes = written(
        few.groupBy("v")
        .agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
        .select(F.concat_ws(":", F.col("ids")[0].cast("string"), F.hex(F.xxhash64("v"))).alias("cls"), "ids", "v"),
        "vectors",
    )
    asking = rows.where("asks").select("v", "vec_id").distinct().join(classes.select("v", "cls"), "v").select("vec_id", "cls")
    asking = written(asking, "queries")
    seekers = classes.join(asking.select("cls").distinct(), "cls", "left_semi").select("cls", "v")

    def merged(found: DataFrame) -> DataFrame:
        """The k + 1 nearest ids of each query class."""
        # blocks may share an id, also one that occurs with several vectors: its best counts
        each = found.groupBy("q", "vec_id").agg(F.max("score").alias("score"), F.max("exact").alias("exact"))
        order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        return each.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")

    found = written(
        merged(_best_in_blocks(_bucket_rows(seekers, PROBES), _bucket_rows(classes.select("cls", "v", "ids"), 1), k + 1)), "found"
    )
    enough = found.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k)
    short = written(seekers.join(enough.select(F.col("q").alias("cls")), "cls", "left_anti"), "short")
    if not short.isEmpty():
        every = F.concat(F.size("v").cast("string"), F.lit(":all")).alias("key")
        rest = merged(_best_in_blocks(short.select(every, "cls", "v"), classes.select(every, "cls", "v", "ids"), k + 1))
        found = found.join(short.select(F.col("cls").alias("q")), "q", "left_anti").unionByName(rest)
    own = (F.col("query_id") != F.col("vec_id"))
    out = asking.select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q")).join(found, "q").where(own)
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        out.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("exact").alias("score"))
    )
