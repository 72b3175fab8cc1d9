"""Ranked search against scoring every document for every query."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import lexical_search as ls
from gaugeworks.llm.common import arrow_batches

TERM = re.compile(ls.TERM_PATTERN)
FOLD = str.maketrans(ls.UPPER, ls.LOWER)


def terms_of(text):
    return TERM.findall((text or "").translate(FOLD))


def brute_force(docs, queries, k):
    """Rows (query_id, rank, doc_id, score) by scoring all documents."""
    counted = [(d, Counter(terms_of(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for q, terms in {(q, tuple(sorted(set(terms_of(t))))) for q, t in queries}:
        scored = []
        for d, c, n in counted:
            m = 50 + (50 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort()
        out += [(q, i + 1, s[3], -s[0]) for i, s in enumerate(scored[:k])]
    return Counter(out)


def found(index, queries, **options):
    return Counter(map(tuple, ls.search(index, queries, **options).collect()))


DOCS = "doc_id long, text string, query string, rank string, score string"
QUERIES = "item_id long, text string, terms string, id string"


def frames(spark, docs, queries):
    d = spark.createDataFrame([(*r, "x", "x", "x") for r in docs], DOCS)
    q = spark.createDataFrame([(*r, "x", "x") for r in queries], QUERIES)
    return d, q


@pytest.mark.parametrize("segment_docs, block_terms", [(2048, 200_000), (7, 400)])
def test_equals_brute_force(spark, docs_rows, monkeypatch, segment_docs, block_terms):
    monkeypatch.setattr(ls, "SEGMENT_DOCS", segment_docs)
    monkeypatch.setattr(ls, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(ls, "SEED_SHARE", 3)
    docs = [(r[0], r[1]) for r in docs_rows]
    docs += docs[:40] + [(None, docs[3][1]), (None, None), (900, ""), (901, " .,;"), (902, "WORD " * 50_000 + docs[5][1])]
    texts = [t for _, t in docs if t]
    queries = [(i, " ".join(t.split()[5:45])) for i, t in enumerate(texts[:25])]
    queries += [(3, "other words der the the THE"), (None, texts[8][:300]), (50, None), (51, "zzzzz qqqqq"), queries[0], queries[0]]
    d, q = frames(spark, docs, queries)
    index = ls.build_index(d.repartition(5))
    for k in (1, 10):
        assert found(index, q, k=k) == brute_force(docs, queries, k)
    index.drop()


def test_ties_copies_and_scripts(spark):
    docs = [(i, "alpha beta beta") for i in range(30, 0, -1)] + [(0, "gamma"), (99, "Ärger ÄRGER straße 日本 alpha")]
    queries = [(1, "ALPHA beta"), (2, "ärger straße 日本"), (3, "Ärger")]
    d, q = frames(spark, docs, queries)
    index = ls.build_index(d)
    got = found(index, q, k=5)
    assert got == brute_force(docs, queries, 5)
    assert [r[2] for r in sorted(got) if r[0] == 1] == [1, 2, 3, 4, 5]


def test_empty_tables(spark):
    d, q = frames(spark, [(1, "alpha beta"), (2, "beta")], [(1, "alpha")])
    none_d, none_q = spark.createDataFrame([], DOCS), spark.createDataFrame([], QUERIES)
    assert ls.search(ls.build_index(d), none_q).count() == 0
    assert ls.search(ls.build_index(none_d), q).count() == 0
    assert ls.search(ls.build_index(none_d), none_q).columns == ["query_id", "rank", "doc_id", "score"]


def test_pair_bounds_open_fewer_lists_and_lose_nothing():
    """Two common-in-short-texts terms that never meet: their pair bound is
    one maximum, so texts with one of them are never opened."""
    import numpy as np
    import pyarrow as pa

    texts = [f"left w{i % 7}" for i in range(50)] + [f"right w{i % 7}" for i in range(50)] + ["left right"]
    texts += ["rare left", "rare right"] * 3
    builder = ls.SegmentBuilder()
    for i, t in enumerate(texts):
        builder.add(i, t.encode())
    n_docs, total = len(texts), sum(len(t.split()) for t in texts)
    row = builder.take("0")
    terms = sorted({b"left", b"right", b"rare"})
    df = dict(zip(row["terms"], row["holders"].tolist()))
    weights = [ls.term_weight(n_docs, df[t]) for t in terms]
    block = ls.QueryBlock([0], terms, weights, [[terms.index(b"rare"), terms.index(b"left"), terms.index(b"right")]])
    segment = dict(row, lengths=np.array(row["lengths"]), terms=pa.array(row["terms"], pa.binary()))
    segment |= {"docs": np.frombuffer(row["docs"], np.int32), "tfs": np.frombuffer(row["tfs"], np.int64)}
    weighed = ls.weigh(segment, block, n_docs, total)
    kinds = {"segment": pa.string()} | {x: pa.binary() for x in ("docs", "impacts", "pair_docs", "joint_impacts")}
    kinds |= {x: pa.list_(pa.int32()) for x in ("terms", "pairs")}
    schema = pa.schema([(n, kinds.get(n, pa.list_(pa.int64()))) for n in weighed])
    search = ls.SegmentSearch(pa.RecordBatch.from_pylist([weighed], schema=schema), 0, block)
    (pair,) = search.pairs
    top, docs, joint = search.pairs[pair]
    assert pair == (terms.index(b"rare"), terms.index(b"left"))
    assert [texts[i] for i in docs] == ["rare left"] * 3 and top == joint.max()
    assert top <= search.maxima[pair[0]] + search.maxima[pair[1]]
    every = {i: s for i, s in zip(*map(np.ndarray.tolist, search.best(0, 0)))}
    for least in sorted(set(every.values())):
        ids, scores = search.best(0, least)
        assert dict(zip(ids.tolist(), scores.tolist())) == {i: s for i, s in every.items() if s >= least}
    assert len(search.best(0, max(every.values()) + 1)[0]) == 0
    assert search.opened <= search.opened_alone


def test_memory_of_a_task_does_not_grow_with_its_partition(spark):
    """One partition of long texts of new words: rows and row groups stay
    bounded (one of each held all of it), and the ranking is whole."""
    import pyarrow.parquet as pq

    draw = random.Random(5)
    words = [[f"{draw.getrandbits(256):064x}" for _ in range(4000)] for _ in range(96)]
    docs = [(i, " ".join(w)) for i, w in enumerate(words)]
    queries = [(i, " ".join(words[i][7:12] + words[i + 1][:2])) for i in range(0, 90, 9)]
    d, q = frames(spark, docs, queries)
    index = ls.build_index(d.coalesce(1))
    text = max(len(t) for _, t in docs)
    sizes = [r.n for r in index.segments.select(F.aggregate("terms", F.lit(0), lambda a, t: a + F.length(t)).alias("n")).collect()]
    assert sum(sizes) == 96 * 4000 * 64
    assert max(sizes) <= ls.SEGMENT_BYTES + text
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in index.segments.inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert len(groups) >= 2 and all(g.num_rows * max(sizes) <= 2 * (ls.GROUP_BYTES + max(sizes)) for g in groups)
    assert found(index, q, k=3) == brute_force(docs, queries, 3)
    index.drop()


def test_workers_get_small_batches(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})

    rows = spark.range(2000, numPartitions=1).select(F.expr("repeat('word ', 2000)").alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    with arrow_batches(spark, ls.BATCH_BYTES):
        got = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 2000 * 10_000 and max(got) <= 1.25 * ls.BATCH_BYTES
    assert spark.conf.get(key, None) == before


def test_packed_numbers_come_back():
    import numpy as np

    for top in (0, 255, 256, 65_535, 65_536, (1 << 32) - 1, 1 << 32):
        values = np.array([0, top, top // 2], np.int64)
        assert ls._unpacked(ls._packed(values), 3).tolist() == values.tolist()
    assert len(ls._unpacked(ls._packed(np.zeros(0, np.int64)), 0)) == 0
