"""Ranked lexical search: MaxScore with pair bounds.

A document's score for a query is the sum, over the query's terms, of
``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` in 64-bit integers, with
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 50 + (50 n N) div L``
(N documents with a term, L their terms, n those of the document).

The index is a table of *segments*: postings (document, tf) by term of some
thousand documents that one task has read.  For a block of queries every
segment is weighed once: the impacts of each term the queries use, its
greatest impact, and for every *pair* of terms that some query joins the
intersection list (the documents holding both, with their joint impact) and
its greatest joint impact J.  A document holds both terms of a pair, or one,
or none, so it gets at most ``max(J, Ma, Mb)`` from them, where MaxScore alone
would allow ``Ma + Mb``.  Each query pairs its terms by falling weight: rare
terms seldom meet, so their pair bound is little more than one maximum.

A query goes through a segment by units (pairs, and a last single term).
Units are sorted by bound; the longest run of small ones whose bounds add up
to less than the least score that still counts cannot bring in a document.
Only the other, essential units open candidates; the rest is looked up for
candidates that can still reach that score.  A segment whose units together
stay below it is skipped.  The least score starts from a sixteenth of the
segments (by hash; their results count like all others) and rises with what
a task finds.

Nothing is sampled: every document is in the index, every pair of query and
document that can be among the best is scored, and ties are kept to the end.

Plan: one pass over texts (no shuffle), an aggregation of document counts by
term, then scans of segments; a task sends on at most ``k`` rows a query, so
no group grows with the table.  Queries are taken in blocks of a bounded
number of terms; only the terms of one block reach the driver.  Memory of a
task is that of a few segments, however many its partition has: a segment is
bounded by text, postings and documents, its numbers are stored as narrow as
they fit, row groups hold a few segments and Arrow batches a few MB.

Defined cases: terms are maximal runs of ASCII letters and digits and of
characters beyond ASCII, A-Z in lower case; a NULL or empty text has none and
is no document; every row is a document, so repeated rows are ranked one
after the other; a NULL id comes behind others of its score; rows of one
query that are equal are one query; a query without known terms has no
result; empty tables give no rows; other columns never matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_batches, drop_written, wide_row_options, written

#: Terms are maximal runs of these: ASCII letters, digits, all beyond ASCII.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes to lower case, those outside terms to blanks.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)

#: A segment is closed at so many documents, postings or bytes of text.
SEGMENT_DOCS = 2048
SEGMENT_POSTINGS = 1_000_000
SEGMENT_BYTES = 8 << 20
#: Bytes of a row group of segments, and of an Arrow batch to a worker.
GROUP_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
#: One segment of so many sets the first bounds.
SEED_SHARE = 16
#: Distinct terms of a block of queries, on average.
BLOCK_TERMS = 200_000

_SEGMENT = "segment string, ids array<bigint>, lengths array<bigint>, terms array<binary>, holders array<bigint>, docs binary, tfs binary"
_WEIGHED = (
    "segment string, ids array<bigint>, terms array<int>, starts array<bigint>, maxima array<bigint>, docs binary, impacts binary, "
    "pairs array<int>, pair_starts array<bigint>, joint_maxima array<bigint>, pair_docs binary, joint_impacts binary"
)
_HIT = "query int, doc_id bigint, score bigint"


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _bytes(values, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 0 or more, each in as few bytes as the largest needs."""
    top = int(values.max(initial=0))
    return _bytes(values, np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.int64)


def _unpacked(buffer, n: int) -> np.ndarray:
    """``n`` numbers, as ``_packed`` stored them."""
    width = len(buffer) // n if n else 8
    return np.frombuffer(buffer, dtype={1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[width])


# --- index ---------------------------------------------------------------


class _Terms(dict):
    def __missing__(self, term):
        self[term] = number = len(self)
        return number


class SegmentBuilder:
    """Postings of the documents added since the last ``take``."""

    def __init__(self):
        self._clear()

    def _clear(self):
        self.terms, self.ids, self.lengths = _Terms(), [], []
        self.numbers, self.tfs, self.sizes = [], [], []
        self.postings = self.text_bytes = 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        found = raw.translate(FOLD).split()
        if not found:
            return
        counts = Counter(found)
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        self.numbers.append(np.fromiter(map(self.terms.__getitem__, counts), np.int32, len(counts)))
        self.tfs.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.sizes.append(len(counts))
        self.postings += len(counts)
        self.text_bytes += len(raw)

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.postings >= SEGMENT_POSTINGS or self.text_bytes >= SEGMENT_BYTES

    def take(self, name: str) -> dict:
        numbers = np.concatenate(self.numbers)
        order = np.argsort(numbers, kind="stable")  # by term, documents ascending
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)[order]
        row = {
            "segment": name,
            "ids": self.ids,
            "lengths": self.lengths,
            "terms": list(self.terms),
            "holders": np.bincount(numbers, minlength=len(self.terms)),
            "docs": _bytes(docs, np.int32),
            "tfs": _bytes(np.concatenate(self.tfs)[order], np.int64),
        }
        self._clear()
        return row


def _stored(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A segment as a row of the table, its numbers packed."""
    packed = {"docs": _packed(np.frombuffer(row["docs"], np.int32)), "tfs": _packed(np.frombuffer(row["tfs"], np.int64))}
    return pa.RecordBatch.from_pylist([row | packed], schema=schema)


@dataclass
class LexicalIndex:
    """Segments (a table in the shared folder) and corpus counts."""

    segments: DataFrame
    n_docs: int
    n_terms: int

    def drop(self) -> None:
        drop_written(self.segments)


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> LexicalIndex:
    """Postings of every whole text of ``docs``, in one pass."""
    schema = _arrow(docs.sparkSession, _SEGMENT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count, now = TaskContext.get().partitionId(), 0, SegmentBuilder()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                now.add(doc_id.as_py(), text.as_buffer().to_pybytes())
                if now.full():
                    yield _stored(now.take(f"{part}-{count}"), schema)
                    count += 1
        if now.ids:
            yield _stored(now.take(f"{part}-{count}"), schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        options = wide_row_options(GROUP_BYTES, ("docs", "tfs"))
        segments = written(rows.mapInArrow(work, _SEGMENT), "segments", options=options)
    sums = segments.select(
        F.size("ids").cast("long").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l")
    )
    n, total = sums.agg(F.sum("n"), F.sum("l")).first()
    return LexicalIndex(segments, n or 0, total or 0)


# --- queries -------------------------------------------------------------


@dataclass
class QueryBlock:
    """Some queries, with the weights of their terms (by number)."""

    ids: list[int | None]
    terms: list[bytes]
    weights: list[int]
    queries: list[list[int]]  # term numbers by falling weight

    def units(self, query: int) -> list[tuple[int, ...]]:
        t = self.queries[query]
        return [tuple(t[i : i + 2]) for i in range(0, len(t), 2)]

    def pairs(self) -> list[tuple[int, int]]:
        return sorted({u for q in range(len(self.queries)) for u in self.units(q) if len(u) == 2})


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def query_terms(text):
    """Distinct terms of a text column."""
    folded = F.translate(text, UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(F.coalesce(folded, F.lit("")), F.lit(f"({TERM_PATTERN})"), F.lit(1)))


def _blocks(index: LexicalIndex, queries: DataFrame, id_col: str, text_col: str) -> Iterator[QueryBlock]:
    # equal rows are one query; a query is told by id and terms from here on
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.array_sort(query_terms(F.col(text_col))).alias("terms"))
    asked = written(asked.distinct().where(F.size("terms") > 0), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_TERMS))
    held = index.segments.select(F.explode(F.arrays_zip("terms", "holders")).alias("t")).select(
        F.col("t.terms").alias("term"), F.col("t.holders").alias("n")
    )
    for block in range(n_blocks):
        mine = asked.where(F.pmod(F.xxhash64("id", "terms"), F.lit(n_blocks)) == block)
        terms = mine.select(F.explode("terms").alias("term")).select(F.col("term").cast("binary").alias("term")).distinct()
        counts = held.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
        df = {bytes(r.term): r.df for r in counts.collect()}  # terms of one block only
        names = sorted(df)
        weights = [term_weight(index.n_docs, df[t]) for t in names]
        number = {t: i for i, t in enumerate(names) if weights[i] > 0}
        ids, lists = [], []
        for r in mine.orderBy(F.asc_nulls_first("id"), "terms").collect():
            known = [number[t.encode()] for t in r.terms if t.encode() in number]
            if known:
                ids.append(r.id)
                lists.append(sorted(known, key=lambda i: (-weights[i], names[i])))
        if ids:
            yield QueryBlock(ids, names, weights, lists)
    drop_written(asked)


# --- weighing: impacts and pair lists --------------------------------------


def weigh(segment: dict, block: QueryBlock, n_docs: int, n_terms: int) -> dict | None:
    """Impact lists of the block's terms and pair lists of its pairs in one
    segment (arrays as in ``_WEIGHED``); ``None`` where it holds no term."""
    where = pc.index_in(pa.array(block.terms, pa.binary()), value_set=segment["terms"])
    at = where.fill_null(-1).to_numpy(zero_copy_only=False)
    weights = np.array(block.weights, np.int64)
    here = np.flatnonzero((at >= 0) & (weights > 0))
    if not len(here):
        return None
    docs, tfs = segment["docs"], segment["tfs"]
    starts = np.concatenate(([0], np.cumsum(segment["holders"])))
    lengths = segment["lengths"]
    m20 = 20 * (50 + 50 * lengths * n_docs // n_terms)
    sizes = starts[at[here] + 1] - starts[at[here]]
    ends = np.zeros(len(here) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    # positions of the chosen lists, one behind the other
    pick = np.arange(ends[-1]) + np.repeat(starts[at[here]] - ends[:-1], sizes)
    docs, tfs = docs[pick], tfs[pick].astype(np.int64)
    gains = 1_000_000_000 * tfs // (1000 * tfs + m20[docs])  # at most a million
    impacts = np.repeat(weights[here], sizes) * gains
    maxima = np.maximum.reduceat(impacts, ends[:-1])

    slot = {int(t): i for i, t in enumerate(here)}
    first = np.full(len(lengths), -1, np.int64)
    pairs, joint_maxima, pair_docs, joint, pair_ends = [], [], [], [], [0]
    last = None
    for a, b in block.pairs():
        if a not in slot or b not in slot:
            continue
        i, j = slot[a], slot[b]
        if last != i:  # where each document stands in the first list
            if last is not None:
                first[docs[ends[last] : ends[last + 1]]] = -1
            first[docs[ends[i] : ends[i + 1]]] = np.arange(ends[i], ends[i + 1])
            last = i
        of_b = docs[ends[j] : ends[j + 1]]
        stands = first[of_b]
        both = stands >= 0
        together = impacts[ends[j] : ends[j + 1]][both] + impacts[stands[both]]
        pairs += [a, b]
        joint_maxima.append(int(together.max(initial=0)))
        pair_docs.append(of_b[both])
        joint.append(together)
        pair_ends.append(pair_ends[-1] + len(together))
    return {
        "segment": segment["segment"],
        "ids": segment["ids"],
        "terms": here.astype(np.int32),
        "starts": ends,
        "maxima": maxima,
        "docs": _packed(docs),
        "impacts": _packed(gains),  # their term's weight comes back in SegmentSearch
        "pairs": pairs,
        "pair_starts": pair_ends,
        "joint_maxima": joint_maxima,
        "pair_docs": _bytes(np.concatenate(pair_docs) if pair_docs else [], np.int32),
        "joint_impacts": _bytes(np.concatenate(joint) if joint else [], np.int64),
    }


def _array(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _buffer(batch: pa.RecordBatch, name: str, row: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), dtype=kind)


def _weighed(index: LexicalIndex, block: QueryBlock) -> DataFrame:
    schema = _arrow(index.segments.sparkSession, _WEIGHED)
    n_docs, n_terms = index.n_docs, index.n_terms

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                segment = {
                    "segment": batch.column("segment")[r].as_py(),
                    "ids": batch.column("ids")[r].as_py(),
                    "lengths": _array(batch, "lengths", r),
                    "terms": batch.column("terms")[r].values,
                    "holders": _array(batch, "holders", r),
                }
                postings = int(segment["holders"].sum())
                segment |= {c: _unpacked(batch.column(c)[r].as_buffer(), postings) for c in ("docs", "tfs")}
                row = weigh(segment, block, n_docs, n_terms)
                if row is not None:
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    return index.segments.mapInArrow(work, _WEIGHED)


# --- search --------------------------------------------------------------


class SegmentSearch:
    """Queries of a block against one weighed segment."""

    def __init__(self, batch: pa.RecordBatch, r: int, block: QueryBlock):
        self.block = block
        ids = batch.column("ids")[r].values
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        ends = _array(batch, "starts", r)
        terms = _array(batch, "terms", r).tolist()
        docs, gains = (_unpacked(batch.column(c)[r].as_buffer(), int(ends[-1])).astype(np.int64) for c in ("docs", "impacts"))
        impacts = gains * np.repeat(np.array(block.weights, np.int64)[terms], np.diff(ends))
        self.lists = {t: (docs[ends[i] : ends[i + 1]], impacts[ends[i] : ends[i + 1]]) for i, t in enumerate(terms)}
        self.maxima = dict(zip(terms, _array(batch, "maxima", r).tolist()))
        pair_docs, joint = _buffer(batch, "pair_docs", r, np.int32), _buffer(batch, "joint_impacts", r, np.int64)
        ends = _array(batch, "pair_starts", r)
        flat = _array(batch, "pairs", r).reshape(-1, 2).tolist()
        self.pairs = {
            (a, b): (int(top), pair_docs[ends[i] : ends[i + 1]], joint[ends[i] : ends[i + 1]])
            for i, ((a, b), top) in enumerate(zip(flat, _array(batch, "joint_maxima", r).tolist()))
        }
        self.scores = np.zeros(len(self.ids), np.int64)
        #: Units looked at, and those that MaxScore without pairs would have opened.
        self.opened = self.opened_alone = 0

    def _bound(self, unit: tuple[int, ...]) -> int:
        if len(unit) == 1 or unit not in self.pairs:
            return max(self.maxima[t] for t in unit)
        a, b = unit
        return max(self.pairs[unit][0], self.maxima[a], self.maxima[b])

    def best(self, query: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of all documents that score ``least`` or more."""
        units = [tuple(t for t in u if t in self.lists) for u in self.block.units(query)]
        units = sorted((self._bound(u), u) for u in units if u)
        rest = np.concatenate(([0], np.cumsum([b for b, _ in units]))) if units else np.zeros(1, np.int64)
        # units before ``open_from`` cannot bring in a document by themselves
        open_from = int(np.searchsorted(rest[1:], least, side="left"))
        self.opened += len(units) - open_from
        alone = np.cumsum(sorted(sum(self.maxima[t] for t in u) for _, u in units))
        self.opened_alone += len(units) - int(np.searchsorted(alone, least, side="left"))
        if open_from == len(units):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores = self.scores
        for _, unit in units[open_from:]:
            for t in unit:
                docs, impacts = self.lists[t]
                scores[docs] += impacts
        found = np.flatnonzero(scores)
        sums = scores[found]
        scores[found] = 0
        for at in range(open_from - 1, -1, -1):
            stays = sums + rest[at + 1] >= least
            found, sums = found[stays], sums[stays]
            unit = units[at][1]
            if unit in self.pairs:
                found, sums, single = self._add_pair(unit, found, sums, least - int(rest[at]))
            else:
                single = np.ones(len(found), bool)
            for t in unit:  # what is not in the intersection holds one of them at most
                if single.any():
                    gain = _looked_up(*self.lists[t], found)
                    sums = sums + np.where(single, gain, 0)
                    single &= gain == 0
        stays = sums >= max(least, 1)
        return found[stays], sums[stays]


    def _add_pair(self, unit: tuple[int, int], found, sums, needed: int):
        """Add the joint impacts of documents in the intersection list; of the
        others, those stay that one of the two terms can bring to ``needed``."""
        _, docs, joint = self.pairs[unit]
        gain = _looked_up(docs, joint, found) if len(docs) else np.zeros(len(found), np.int64)
        single = gain == 0
        stays = ~single | (sums + max(self.maxima[t] for t in unit) >= needed)
        return found[stays], (sums + gain)[stays], single[stays]


def _looked_up(docs: np.ndarray, impacts: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Impacts of the documents ``found`` in one list (0: not in it)."""
    place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
    return np.where(docs[place] == found, impacts[place], 0)


class _Top:
    """The k best documents of one query: by score, then id (NULL last)."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores = self.ids = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        if not len(scores):
            return
        self.scores = np.concatenate((self.scores, scores))
        self.ids = np.concatenate((self.ids, ids))
        self.no_id = np.concatenate((self.no_id, no_id))
        if len(self.scores) > self.k:
            order = np.lexsort((self.ids, self.no_id, -self.scores))[: self.k]
            self.scores, self.ids, self.no_id = self.scores[order], self.ids[order], self.no_id[order]
        if len(self.scores) == self.k:
            self.least = max(self.least, int(self.scores.min()))


def _hits(weighed: DataFrame, block: QueryBlock, least: list[int], k: int) -> DataFrame:
    """At most ``k`` rows a query and task: ``query, doc_id, score``."""
    schema = _arrow(weighed.sparkSession, _HIT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [_Top(k, v) for v in least]
        for batch in batches:
            for r in range(batch.num_rows):
                segment = SegmentSearch(batch, r, block)
                for q, top in enumerate(tops):
                    docs, scores = segment.best(q, top.least)
                    top.add(scores, segment.ids[docs], segment.no_id[docs])
        for q, top in enumerate(tops):
            if len(top.scores):
                ids = pa.array(top.ids, pa.int64(), mask=top.no_id)
                columns = [pa.array(np.full(len(top.scores), q, np.int32)), ids, pa.array(top.scores)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return weighed.mapInArrow(work, _HIT)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    index: LexicalIndex, queries: DataFrame, *, k: int = 50, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` best documents of every
    query with a score above 0, by score and then ascending id."""
    spark = queries.sparkSession
    out = None
    for block in _blocks(index, queries, id_col, text_col):
        with arrow_batches(spark, BATCH_BYTES):
            options = wide_row_options(GROUP_BYTES, ("docs", "impacts", "pair_docs", "joint_impacts"))
            weighed = written(_weighed(index, block), "weighed", options=options)
            seed = F.pmod(F.xxhash64("segment"), F.lit(SEED_SHARE)) == 0
            none = [0] * len(block.ids)
            first = written(_ranked(_hits(weighed.where(seed), block, none, k), k), "hits")
            least = list(none)
            for r in first.where(F.col("rank") == k).collect():
                least[r["query"]] = r["score"]
            others = _hits(weighed.where(~seed), block, least, k)
            best = _ranked(first.drop("rank").unionByName(others), k)
            ids = spark.createDataFrame([(i, v) for i, v in enumerate(block.ids)], "query int, query_id bigint")
            found = written(best.join(F.broadcast(ids), "query").select("query_id", "rank", "doc_id", "score"), "found")
        drop_written(weighed)
        drop_written(first)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, rank int, doc_id bigint, score bigint")
    return out
