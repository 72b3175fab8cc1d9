"""MinHash near-duplicates with sequential Bayesian verification.

A document is the set of its distinct word 5-shingles (64-bit hashes).
Documents with equal sets form a class, and only classes are compared.
MinHash signatures of the classes are banded; classes that share a band
are candidates.  A candidate's signatures are compared batch by batch, and it is
pruned as soon as the posterior probability (uniform prior) that its
similarity reaches the threshold falls below ``MISS``.  Survivors are
verified exactly on their full sets.

Candidates are taken in two steps, so that a group of thousands of near
copies costs a number of pairs in proportion to it:

1. every class against the hub of each of its bands: the class that
   shares the most bands with others (of a text and its copies, the text);
2. what step 1 left apart: in bands that still hold several components,
   the classes outside the largest one against all classes of other
   components.  Pairs inside one component cannot change it and are never
   made, nor are pairs that cannot reach the threshold: a shingle that no
   other class of step 2 holds is in no intersection, so with ``c``
   shingles shared with anyone, ``c_min >= 0.85 (n_a + n_b - c_min)`` must hold.

After step 2 every pair that shares a band is linked, refuted or inside
one component, so components equal those of all banded pairs.  A pair at
the threshold shares no band with probability ``(1 - 0.85**6)**32``, 3e-7.

Signatures, bands, sets and links live in written tables of the shared
folder; the driver sees counts only.

Defined cases: a text that is NULL, empty or white space has no shingles
and is linked with nothing: it is its own component, and kept.  Fewer
than five words are one shingle.  Ids may be NULL or repeat: rows are
linked by content; NULL ids are ignored as component ids, and a component
of NULL ids alone has a NULL id and is not kept.  Only the two named
columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, in_few_parts, written
from .graph import components

WORDS = 5
PERCENT = 85
BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-6
BLOCK = 2048
SEED = 11

_U64 = np.uint64


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text.

    ``bytes.lower`` maps A-Z only and ``bytes.split`` divides at \\x20 and
    \\x09-\\x0D only."""
    tokens = text.encode("utf-8").lower().split() if text else []
    if not tokens:
        return np.empty(0, dtype=_U64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))], dtype=_U64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=_U64, count=len(tokens))
    n = len(h) - words + 1
    x = np.zeros(n, dtype=_U64)
    for k in range(words):
        x = _mix64(x * _U64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(x)


def hash_parameters(hashes: int = HASHES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 32, hashes, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, hashes, dtype=np.uint64).astype(np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> _U64(32)).astype(np.uint32)
    out = np.full(len(a), np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 256):
        np.minimum(out, (x[i : i + 256, None] * a + b).min(axis=0), out=out)
    return out


def least_matches(
    hashes: int = HASHES, batch: int = BATCH, percent: int = PERCENT, miss: float = MISS
) -> list[tuple[int, int]]:
    """``(compared, matches)``: with fewer matches among so many hashes, the
    posterior of similarity >= percent / 100 under a uniform prior is below
    ``miss``.  With m of n equal it is the upper tail of Beta(m + 1, n - m
    + 1), a binomial sum."""
    t, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        term = [comb(n + 1, j) * t**j * (1 - t) ** (n + 1 - j) for j in range(n + 2)]
        # P(S >= t | m) = P(Binomial(n + 1, t) <= m)
        total, least = 0.0, 0
        for m in range(n + 1):
            total += term[m]
            if total >= miss:
                least = m
                break
        out.append((n, least))
    return out


def survives(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices are never pruned; a batch of
    hashes is compared only for the rows still open."""
    open_rows = np.arange(len(x))
    matches = np.zeros(len(x), dtype=np.int64)
    done = 0
    for n, least in steps:
        matches[open_rows] += (x[open_rows, done:n] == y[open_rows, done:n]).sum(axis=1)
        open_rows = open_rows[matches[open_rows] >= least]
        done = n
    out = np.zeros(len(x), dtype=bool)
    out[open_rows] = True
    return out


def _matrix(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, hashes)


def document_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, n, node, sig`` of each document; ``node`` names
    its set (NULL where empty)."""
    a, b = hash_parameters()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, sigs = [], [], []
            for value in batch.column(2):
                s = shingle_set(value.as_py())
                sizes.append(len(s))
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s, a, b).astype("<u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "text_hash", "n", "node", "sig"],
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(sets, "doc_id bigint, text_hash bigint, n bigint, node binary, sig binary")


def band_rows(classes: DataFrame) -> DataFrame:
    """``band, slot, node``: a 64-bit key of each band of each class and
    the number of the band."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = _matrix(batch.column(1), HASHES).reshape(-1, BANDS, ROWS).astype(_U64)
            keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U64), sigs.shape[:2]).copy()
            for k in range(ROWS):
                keys = _mix64(keys * _U64(0x9E3779B97F4A7C15) + sigs[:, :, k])
            nodes = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
            slots = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(slots), nodes], names=["band", "slot", "node"]
            )

    return classes.select("node", "sig").mapInArrow(bands, "band bigint, slot int, node binary")


def prune(pairs: DataFrame, classes: DataFrame, rows: int | None = None) -> DataFrame:
    """Pairs ``(a, b)``, at most ``rows``, whose sizes and signatures allow the threshold."""
    steps = least_matches()

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = survives(_matrix(batch.column(2), HASHES), _matrix(batch.column(3), HASHES), steps)
                yield pa.RecordBatch.from_arrays(
                    [c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"]
                )

    one = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    two = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    both = pairs.join(one, "a").join(two, "b").where(small * 100 >= large * PERCENT)
    return in_few_parts(both.select("a", "b", "sig_a", "sig_b"), rows).mapInArrow(test, "a binary, b binary")


def class_shingles(
    needed: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, rows: int | None = None
) -> DataFrame:
    """``node, items`` (the full set, as bytes) of the classes in
    ``needed(node)``, at most ``rows``, made anew from one text of each."""
    where = needed.join(classes.select("node", "rep"), "node").select("node", "rep.doc_id", "rep.text_hash")
    text = docs.select(
        F.col(id_col).cast("bigint").alias("d"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.col(text_col).cast("string").alias("text"),
    )
    found = text.join(where, (F.col("h") == F.col("text_hash")) & F.col("d").eqNullSafe(F.col("doc_id")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(v.as_py()) for v in batch.column(1)]
            # texts whose hashes clash are told apart by the set itself
            same = [xxhash.xxh3_128_digest(s.tobytes()) == v.as_py() for s, v in zip(made, batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(same, pa.bool_())), pa.array([s.tobytes() for s, ok in zip(made, same) if ok], pa.binary())],
                names=["node", "items"],
            )

    items = in_few_parts(found.select("node", "text"), rows).mapInArrow(sets, "node binary, items binary")
    # a row that repeats id and text would come twice
    return items.dropDuplicates(["node"])


def verify(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, rows: int | None = None
) -> DataFrame:
    """Pairs whose full sets reach the threshold; ``rows`` bounds the number of
    classes, and with its bands that of pairs."""
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    items = written(class_shingles(needed, classes, docs, id_col, text_col, rows), "shingles", rows)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=_U64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"]
            )

    both = pairs.join(items.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(
        items.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"
    )
    both = in_few_parts(both.select("a", "b", "x", "y"), rows and BANDS * rows)
    return both.mapInArrow(confirm, "a binary, b binary")


def shared_counts(items: DataFrame) -> DataFrame:
    """``node, n, c``: size of each set of ``items`` and how many of its
    shingles some other set holds too."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in batch.column(1)]
            if sets:
                nodes = batch.column(0).take(pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(np.concatenate(sets))], names=["node", "item"])

    owners = items.mapInArrow(listed, "node binary, item bigint").groupBy("item")
    single = owners.agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("node")).where("k = 1")
    alone = single.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    size = (F.octet_length("items") / 8).cast("bigint")
    return items.select("node", size.alias("n")).join(alone, "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("c")
    )


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows ``band, node, root, ...`` of bands with several components,
    with the component ``main`` that has the most classes there."""
    per_root = rows.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
    main = per_root.groupBy("band").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("roots")
    )
    return rows.join(main.where("roots > 1").select("band", "main"), "band")


def _apart(
    shared: DataFrame, roots: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, rows: int
) -> DataFrame:
    """Step 2: candidate pairs of classes in different components."""
    others = shared.where("node != hub").join(roots, "node", "left").select("band", "slot", "node", F.coalesce("root", "node").alias("root"))
    # the hub of a band met all others in step 1
    left = written(_mixed(others).drop("main"), "apart", BANDS * rows)
    items = written(class_shingles(left.select("node").distinct(), classes, docs, id_col, text_col, rows), "shingles", rows)
    known = left.join(written(shared_counts(items), "counts", rows), "node")
    # a class too rich in shingles of its own for the smallest set of a band has no partner there
    smallest = known.groupBy("band").agg(F.min("n").alias("least_n"))
    able = known.join(smallest, "band").where(f"100 * c >= {PERCENT} * (n + least_n - c)").drop("least_n")
    able = written(_mixed(able), "apart", BANDS * rows)
    return _close_in_blocks(able.join(classes.select("node", "sig"), "node"), rows=BANDS * rows)


def _ranks(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Columns of bytes as numbers in the same order."""
    values = [c.to_pylist() for c in columns]
    rank = {v: i for i, v in enumerate(sorted(set().union(*values)))}
    return [np.array([rank[v] for v in column], dtype=np.int64) for column in values]


def _close_in_blocks(able: DataFrame, block: int = BLOCK, rows: int | None = None) -> DataFrame:
    """Pairs ``(a, b)`` of ``able`` that survive pruning, each once.

    A band with many classes is cut into blocks on either side; a pair of
    blocks is compared in one task, so candidates are never rows.  A pair that
    shares several bands is reported by the first of them."""
    steps = least_matches()
    columns = ["band", "slot", "node", "root", "main", "n", "c", "sig"]
    minor = F.col("root") != F.col("main")
    sizes = able.groupBy("band").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("parts"),
        F.ceil(F.count(F.when(minor, 1)) / F.lit(block)).alias("asks"),
    )
    dealt = written(able.join(sizes.where("asks > 0"), "band"), "blocks", rows)
    place = F.xxhash64("node")
    zero = F.lit(0).cast("bigint")
    left = dealt.where(minor).withColumn("ask", F.pmod(place, "asks")).withColumn(
        "part", F.explode(F.sequence(zero, F.col("parts") - 1))
    )
    right = dealt.withColumn("part", F.pmod(place, "parts")).withColumn(
        "ask", F.explode(F.sequence(zero, F.col("asks") - 1))
    )

    def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = ([], [])
        if ours.num_rows and theirs.num_rows:
            node_a, node_b, root_a, root_b, main = _ranks(
                ours["node"], theirs["node_"], ours["root"], theirs["root_"], theirs["main_"]
            )
            n_a, c_a, n_b, c_b = (t[k].to_numpy() for t, k in zip((ours, ours, theirs, theirs), ("n", "c", "n_", "c_")))
            x, y = _matrix(ours["sig"], HASHES), _matrix(theirs["sig_"], HASHES)
            slot = ours["slot"][0].as_py()
            for i in range(len(x)):
                shared = np.minimum(c_a[i], c_b)
                may = (root_b != root_a[i]) & ((root_b == main) | (node_b > node_a[i]))
                at = np.flatnonzero(may & (100 * shared >= PERCENT * (n_a[i] + n_b - shared)))
                if at.size:
                    at = at[survives(np.broadcast_to(x[i], (len(at), HASHES)), y[at], steps)]
                    same = (y[at] == x[i]).reshape(-1, BANDS, ROWS).all(axis=2)
                    at = at[same.argmax(axis=1) == slot]
                    found[0].append(np.full(len(at), i))
                    found[1].append(at)
        i, j = (np.concatenate(f) if f else np.empty(0, dtype=np.int64) for f in found)
        return pa.table(
            {"a": ours["node"].take(pa.array(i, pa.int64())), "b": theirs["node_"].take(pa.array(j, pa.int64()))}
        )

    keys = ["band", "part", "ask"]
    other = right.select(*[F.col(k).alias(f"{k}_") for k in ("part", "ask", *columns)])
    pairs = (
        left.select("part", "ask", *columns)
        .groupBy(*keys)
        .cogroup(other.groupBy(*[f"{k}_" for k in keys]))
        .applyInArrow(lambda ours, theirs: compare(ours, theirs), "a binary, b binary")
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept, root`` of every
    row; ``root`` names the component by content (NULL without shingles)."""
    sets = written(document_sets(docs, id_col, text_col), "sets")
    rows = sets.count()  # bounds the tables below, which are often far smaller than the partitions they leave
    classes = written(
        sets.where("node is not null")
        .groupBy("node")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"),
            F.min("doc_id").alias("least_id"),
            F.first("n").alias("n"),
            F.first("sig").alias("sig"),
        ),
        "classes",
        rows,
    )
    # bands with one class can be dropped before anything is paired
    bands = band_rows(classes).repartition("band")
    several = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    crowded = written(bands.join(several, "band"), "bands", BANDS * rows)
    degree = crowded.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = crowded.join(degree, "node").groupBy("band").agg(F.max_by("node", F.struct("degree", "node")).alias("hub"))
    shared = written(crowded.select("band", "slot", "node").join(hubs, "band"), "bands", BANDS * rows)

    ends = F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")
    stars = shared.where("node != hub").select(*ends).distinct()
    close = written(prune(stars, classes, BANDS * rows), "close")
    first = written(verify(close, classes, docs, id_col, text_col, rows), "verified")
    roots = written(components(first, BANDS * rows), "roots", rows)
    apart = written(_apart(shared, roots, classes, docs, id_col, text_col, rows), "close", BANDS * rows)
    if not apart.isEmpty():
        second = written(verify(apart, classes, docs, id_col, text_col, rows), "verified")
        if not second.isEmpty():
            roots = written(components(first.unionByName(second), BANDS * rows), "roots", rows)
    named = classes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_node = named.select("node", "root").join(ids, "root")
    out = sets.select("doc_id", "text_hash", "n", "node").join(of_node, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        "root",
    )


def keep_representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with the columns of the
    input: of the group, the row with the smallest id (NULL last), then
    the smallest hash of the text; of rows equal in both, one.  Rows
    without words are no group and all stay."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col)
    own_id, own_hash, of_id, of_hash = free_names(docs.columns, "_nd_i", "_nd_h", "_nd_id", "_nd_hash")
    # a group's choice is an aggregate, so large groups shrink before the shuffle
    chosen = (
        found.where("root is not null")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("m"))
        .select(F.col("m.doc_id").alias(of_id), F.col("m.text_hash").alias(of_hash))
    )
    empty = docs.where(~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    texts = docs.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = texts.select(*columns, F.col(id_col).cast("bigint").alias(own_id), F.xxhash64(F.col(text_col)).alias(own_hash))
    kept = keyed.join(
        chosen, F.col(own_id).eqNullSafe(F.col(of_id)) & (F.col(own_hash) == F.col(of_hash)), "left_semi"
    )
    once = kept.dropDuplicates([own_id, own_hash]).select(*columns)
    return once.unionByName(empty.select(*columns))
