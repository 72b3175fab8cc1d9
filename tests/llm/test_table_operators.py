"""Operators over whole tables against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm import common, graph, mixing, near_dedup, neighbours, preferences, queries, url_filter

from ..conftest import SF_CHECK, SF_SMALL
from .conftest import ODD
from .test_text_operators import WORD, bands_by_hand, base_by_regex


def shingles(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = WORD.findall((text or "").translate(table))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def groups_by_force(rows):
    """(size, component, kept) of each (id, text), all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= 85 * max(len(sets[i]), len(sets[j])):
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                    root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        own = [x for x in ids[find(i)] if x is not None]
        c = min(own) if own and sets[i] else (d if not sets[i] else None)
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("folder", [SF_SMALL, SF_CHECK])
def test_near_dedup_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op5_near_dedup(spark, folder).collect()]
    assert ordered(got) == ordered(groups_by_force(rows))


def near_copies(n, seed=3):
    """A chain of copies (neighbours linked, ends far apart), a star of
    copies of one text, and texts that share a passage only."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(10**6)}"
    out, text = [], [word() for _ in range(200)]
    for _ in range(n):
        text = list(text)
        for i in rng.choice(200, 3, replace=False):
            text[i] = word()
        out.append(" ".join(text))
    base = [word() for _ in range(300)]
    for _ in range(n):
        copy = list(base)
        for i in rng.choice(300, int(rng.integers(1, 9)), replace=False):
            copy[i] = word()
        out.append(" ".join(copy))
    passage = [word() for _ in range(80)]
    out += [" ".join(passage + [word() for _ in range(int(rng.integers(5, 80)))]) for _ in range(n)]
    return list(enumerate(out))


def test_near_dedup_chains_and_stars(spark):
    rows = near_copies(30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert ordered(map(tuple, got)) == ordered(groups_by_force(rows))


def test_near_dedup_odd_rows(spark, odd, empty):
    got = near_dedup.near_duplicates(odd).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert ordered(map(tuple, got)) == ordered(groups_by_force([r[:2] for r in ODD]))
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.keep_representatives(odd)
    assert kept.columns == odd.columns
    # ids 1-3 have no words; 4 stands for itself, its repetition and the NULL id; 5 for 6
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8, 9, 10]


def test_near_dedup_small_tables_in_few_files(spark, monkeypatch):
    # many shuffle partitions, and nothing that coalesces them
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    monkeypatch.setattr(common, "PARTS_A_CORE", 1)
    files = []

    def counted(*args):
        out = common.written(*args)
        files.append((args[1], len(out.inputFiles())))
        return out

    monkeypatch.setattr(near_dedup, "written", counted)
    monkeypatch.setattr(graph, "written", counted)
    rows = near_copies(12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 4 * cores)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = near_dedup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert ordered(map(tuple, got)) == ordered(groups_by_force(rows))
    assert {"classes", "bands", "close", "shingles", "verified", "links", "roots"} <= {k for k, _ in files}
    assert all(n <= cores for k, n in files if k != "sets"), files


def test_few_parts_grow_with_the_rows(spark):
    df = spark.range(0, 1000, 1, 10 * spark.sparkContext.defaultParallelism)
    parts = lambda rows: common.in_few_parts(df, rows).rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    assert parts(None) == 10 * cores and parts(0) == parts(1000) == 8 * cores
    assert parts(9 * cores * common.ROWS_A_PART) == 9 * cores
    assert parts(10**12) == 10 * cores


def test_pruning_bounds():
    steps = near_dedup.least_matches()
    assert [n for n, _ in steps] == list(range(32, 193, 32))
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**32, (4000, 192), dtype=np.uint64).astype(np.uint32)
    equal = rng.random((4000, 192)) < 0.85
    assert near_dedup.survives(x, np.where(equal, x, x + np.uint32(1)), steps).all()
    equal = rng.random((4000, 192)) < 0.5
    assert not near_dedup.survives(x, np.where(equal, x, x + np.uint32(1)), steps).any()


def test_signature_estimates_similarity():
    a, b = near_dedup.hash_parameters(2048)
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    x, y = near_dedup.signature(pool[:1200], a, b), near_dedup.signature(pool[300:], a, b)
    assert abs((x == y).mean() - 900 / 1500) < 0.05


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 200) if i != 99] + [(500, 400), (400, 450), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, graph.components(df).collect()))
    assert got == {i: 0 if i < 100 else 100 for i in range(201)} | {400: 400, 450: 400, 500: 400}
    assert graph.components(df.limit(0)).count() == 0


def cosines(vectors):
    x = np.array(vectors, dtype=np.float64)
    return (x @ x.T) / np.sqrt((x * x).sum(1)[:, None] * (x * x).sum(1)[None, :])


def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").orderBy("vec_id").collect()
    ids = [r["vec_id"] for r in rows]
    s = cosines([r["embedding"] for r in rows])
    got = defaultdict(list)
    for r in sorted(queries.op8_neighbours(spark, SF_CHECK).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert abs(r["score"] - s[ids.index(r["query_id"]), ids.index(r["vec_id"])]) < 1e-14
        got[r["query_id"]].append(r["vec_id"])
    hits = 0
    for q in [i for i in ids if i % 50 == 0]:
        order = sorted((-s[ids.index(q), j], i) for j, i in enumerate(ids) if i != q)
        assert len(got[q]) == 5
        hits += len(set(got[q]) & {i for _, i in order[:5]})
    assert hits / (5 * len(got)) >= 0.9


def test_neighbours_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 4)
    v = [1.0, 2.0, 0.0, -1.0]
    rows = [(i, v) for i in range(0, 900, 3)] + [(1, [2.0, 4.0, 0.0, -2.0]), (2, [0.0, 0.0, 1.0, 0.0])]
    rows += [(4, None), (5, [0.0] * 4), (7, [1.0, None, 0.0, 0.0]), (8, [float("nan"), 1.0, 1.0, 1.0]), (10, [float("inf")] * 4)]
    rows += [(11, []), (None, v), (13, [1.0, 1.0]), (14, [1.0, 0.5]), (3, v), (50, [1e200, 2e200, 0.0, -1e200])]
    df = spark.createDataFrame([r + (1.0, "x") for r in rows], "vec_id long, embedding array<double>, score double, v string")
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    assert got[150] == [(0, 1.0), (1, 1.0), (3, 1.0), (6, 1.0), (9, 1.0)]
    assert got[0] == [(1, 1.0), (3, 1.0), (6, 1.0), (9, 1.0), (12, 1.0)]
    assert got[50] == got[150]
    small = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1.0, 0.5]), (2, [-1.0, 0.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in neighbours.nearest(small, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_repeated_rows_take_no_place(spark):
    v = [1.0, 2.0, 0.0, -1.0]
    rows = [(1, v)] * 7 + [(i, v) for i in range(2, 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id").isin(1, 3, 11)).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == {1: [2, 3, 4, 5, 6], 3: [1, 2, 4, 5, 6], 11: [1, 2, 3, 4, 5]}


def test_neighbours_cut_by_ids_and_ties(spark):
    """Every bucket of four axes is probed, so the answer is the exact one:
    many vectors at one cosine, ids with many near vectors."""
    rng = np.random.default_rng(4)
    rows = {(0, (1.0, 0.0, 0.0, 0.0)), (50, (9.0, 1.0, 0.0, 0.0))}
    rows |= {(int(i), (s, s, 0.0, 0.0)) for s, i in enumerate(rng.permutation(np.arange(100, 180)), 1)}
    rows |= {(i, (100.0, float(j), 0.0, 0.0)) for i in (0, 7) for j in range(1, 20)}
    rows |= {(int(i), tuple(v)) for i, v in zip(rng.integers(200, 260, 150), rng.integers(-2, 3, (150, 4)).astype(float)) if any(v)}
    rows |= {(int(i), (float(s), 0.0, float(s), 0.0)) for s, i in zip(range(1, 30), rng.permutation(np.arange(60, 100)))}
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>")
    vectors = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    ids = [i for i, _ in rows]
    want = []
    for (q, _), x in zip(rows, vectors):
        if q % 50 == 0:
            best = defaultdict(lambda: -2.0)
            for i, y in zip(ids, vectors):
                best[i] = max(best[i], round(float(x @ y), 9))
            order = sorted((-s, i) for i, s in best.items() if i != q)[:5]
            want += [(q, r, i) for r, (_, i) in enumerate(order, 1)]
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 48))
    y = neighbours.rotate(x, 3)
    assert y.shape == (5, 64) and np.allclose(x @ x.T, y @ y.T)
    dense = np.array([[1.0]])
    while len(dense) < 64:
        dense = np.block([[dense, dense], [dense, -dense]])
    z = np.random.default_rng(1).normal(size=(3, 64))
    assert np.allclose(neighbours.hadamard(z), z @ dense / 8)


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path.split("?")[0].split("#")[0]


def fitting_rule(host, path):
    found = []
    for verdict, rule in queries.URL_RULES:
        rule_host, rule_path = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            found.append((len(rule), rule, verdict))
    return max(found)[1:] if found else (None, None)


def markov_by_hand(texts, order=3):
    """Witten-Bell by dictionaries: probability of a symbol after a context."""
    n, kinds = defaultdict(lambda: defaultdict(int)), url_filter._SIZE
    fold = lambda c: c.lower() if c.isascii() and c.lower() in url_filter.SYMBOLS else "\0"
    for t in texts:
        s = ["^"] * order + [fold(c) for b in t for c in ([b] if b.isascii() else ["\0"] * len(b.encode()))]
        for i in range(order, len(s)):
            for k in range(order + 1):
                n[tuple(s[i - k : i])][s[i]] += 1

    def p(context, c):
        lower = 1 / kinds if not context else p(context[1:], c)
        seen = n.get(context)
        if context and not seen:
            return lower
        seen = seen or {}
        total = sum(seen.values())
        return (seen.get(c, 0) + len(seen) * lower) / (total + len(seen)) if total else lower

    return lambda s: sum(math.log(p(tuple(s[i - order : i]), s[i])) for i in range(order, len(s)))


def test_url_query(spark):
    import zlib

    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: r for r in queries.op9_url_filter(spark, SF_CHECK).collect()}
    assert len(got) == len(pages)
    train = {"allow": [], "block": []}
    held = []
    for page_id, url in pages:
        host, path = url_parts(url)
        rule, verdict = fitting_rule(host, path)
        r = got[page_id]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule:
            assert r["verdict"] == verdict
            (held.append((r["log_ratio"], verdict)) if zlib.crc32(url.encode()) % 5 == 0 else train[verdict].append(url))
    allow, block = (markov_by_hand(train[c]) for c in ("allow", "block"))
    urls = dict(pages)
    for r in list(got.values())[:80]:
        s = ["^"] * 3 + list(urls[r["page_id"]].lower())
        assert abs(r["log_ratio"] - (allow(s) - block(s)) / (len(s) - 3)) < 1e-3
    # the verdicts without a rule follow one limit
    rest = [r for r in got.values() if r["rule"] is None]
    passed, failed = ([r["log_ratio"] for r in rest if r["verdict"] == v] for v in ("allow", "block"))
    assert not passed or not failed or min(passed) >= max(failed)
    wrong = np.mean([(x > 0) != (v == "allow") for x, v in held])
    assert wrong < 0.2


def test_url_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (None, "HTTP://A.Example.ORG"), (4, "x://EXAMPLE.org/es/1?q://z"), (4, "x://EXAMPLE.org/es/1?q://z"),
            (5, "http://org/"), (6, "http://notorg/a"), (7, "http://ü.com/fr/é#x"), (8, "http://b.com/de/" + "a" * 100_000), (9, "a://"), (10, "http://q.net?x=/y")]
    df = spark.createDataFrame([r + ("h", "p", "v") for r in rows], "page_id long, url string, host string, path string, verdict string")
    rules = [url_filter.split_rule(*r) for r in queries.URL_RULES]
    got = url_filter.judge_urls(df, rules).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *url_parts(u), fitting_rule(*url_parts(u))[0]) for i, u in rows), key=str)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in got), key=str) == want
    assert all(r["verdict"] == "block" and r["log_ratio"] == 0 for r in got if r["page_id"] in (1, 2))
    assert all(r["log_ratio"] != 0 for r in got if r["page_id"] in (3, 9))
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


def test_url_parts_beyond_the_path_are_judged(spark):
    rules = [("allow", "ok.org", "/"), ("block", "bad.org", "/")]
    rows = [(i, f"http://ok.org/p?item=good{i}#top") for i in range(60)]
    rows += [(100 + i, f"http://bad.org/p?buy=pills{i}") for i in range(60)]
    rows += [(200, "http://q.net/p?item=good3"), (201, "http://q.net/p?buy=pills3"), (202, "q.net/p?item=good"), (203, "q.net/p?buy=pills")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, rules).collect()}
    assert [got[i]["verdict"] for i in range(200, 204)] == ["allow", "block", "allow", "block"]
    assert got[200]["log_ratio"] > got[201]["log_ratio"] and got[202]["log_ratio"] > got[203]["log_ratio"]


def test_limit_of_least_error():
    hist = np.zeros((2, url_filter.BINS))
    mid = url_filter.BINS // 2
    hist[0, mid - 300 : mid - 100] = 1
    hist[1, mid + 200 : mid + 400] = 1
    limit = url_filter.limit_of_least_error(hist)
    assert -100 * 0.005 < limit < 200 * 0.005
    assert url_filter.limit_of_least_error(np.zeros((2, url_filter.BINS))) == 0.0


def test_mixture_meets_targets(spark):
    tokens = {"a": 900_000, "b": 50_000, "c": 30_000, "d": 20_000}
    df = spark.createDataFrame([(s, 1, n) for s, n in tokens.items()], "source string, n_docs long, tokens long")
    total = sum(tokens.values())

    def entropy(w):
        return -sum(x * math.log(x) for x in w)

    rows = mixing.mixture(df, total, target_entropy=0.9, max_repeats=None).collect()
    assert abs(entropy([r["weight"] for r in rows]) - 0.9 * math.log(4)) < 1e-6
    a = rows[0]["exponent"]
    z = sum((n / total) ** a for n in tokens.values())
    for r in rows:
        assert abs(r["weight"] - (tokens[r["source"]] / total) ** a / z) < 1e-9
    rows = mixing.mixture(df, total, target_entropy=0.99, max_repeats=3.0).collect()
    assert abs(max(r["weight"] * total / r["tokens"] for r in rows) - 3.0) < 1e-6
    equal = mixing.mixture(df, total, target_entropy=1.0, max_repeats=None).collect()
    assert all(abs(r["weight"] - 0.25) < 1e-6 for r in equal)
    kept = mixing.mixture(df, total, target_entropy=0.0, max_repeats=None).collect()
    assert all(r["quota"] == r["tokens"] for r in kept)


def check_mix(used, docs, quota):
    """Uses of (id, source, tokens, epoch, before): passes complete in
    order, quotas met to one document."""
    by = defaultdict(list)
    for u in used:
        by[u[1]].append(u)
    for source, uses in by.items():
        uses.sort(key=lambda u: (u[3], u[4], u[2]))
        at = 0
        for _, _, n, _, before in uses:
            assert before == at
            at += n
        assert at >= quota[source] and (not uses[-1][2] or at - uses[-1][2] < quota[source])
        whole = sorted(d for d, s, _ in docs if s == source)
        for e in range(max(u[3] for u in uses)):
            assert sorted(u[0] for u in uses if u[3] == e) == whole


def test_mix_query(spark):
    docs = [(r[0], r[2], len(WORD.findall(r[1]))) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    size = {d: n for d, _, n in docs}
    sources = defaultdict(int)
    for _, s, n in docs:
        sources[s] += n
    df = spark.createDataFrame([(s, 1, n) for s, n in sources.items()], "source string, n_docs long, tokens long")
    quota = {r["source"]: r["quota"] for r in mixing.mixture(df, sum(sources.values())).collect()}
    used = [(r["doc_id"], r["source"], size[r["doc_id"]], r["epoch"], r["tokens_before"]) for r in queries.op4_mixing(spark, SF_SMALL).collect()]
    check_mix(used, docs, quota)


def test_mix_small_blocks_and_repeats(spark):
    rng = np.random.default_rng(4)
    docs = [(i, "hot" if i % 3 else f"s{i % 4}", int(rng.integers(1, 50))) for i in range(300)]
    df = spark.createDataFrame([(d, "x " * n, s, n) for d, s, n in docs], "doc_id long, text string, source string, tokens int")
    mixed = mixing.mix(df, block_tokens=200, budget_tokens=20_000, target_entropy=1.0, max_repeats=None)
    used = [(r["doc_id"], r["source"], r["tokens"], r["_mix_epoch"], r["_mix_before"]) for r in mixed.collect()]
    names = {s for _, s, _ in docs}
    check_mix(used, docs, {s: round(20_000 / len(names)) for s in names})


def test_mix_odd_rows(odd, empty):
    out = mixing.mix(odd, target_entropy=0.0, max_repeats=None)
    assert out.columns[: len(odd.columns)] == odd.columns
    # exponent 1: every document with tokens once, repeated rows as often as they are
    got = sorted(str(r["doc_id"]) for r in out.collect() if r["text"] and r["text"].strip())
    assert got == sorted(str(r[0]) for r in ODD if r[1] and r[1].strip())
    assert mixing.mix(empty).count() == 0
    # columns with the names used inside come through
    names = ["_mix_x", "_mix_epoch", "_MIX_id", "_mix_source", "c"]
    clash = odd.withColumns({n: F.lit("x") for n in names})
    again = mixing.mix(clash, target_entropy=0.0, max_repeats=None)
    assert again.columns == [*clash.columns, "_mix_epoch_", "_mix_block", "_mix_before"]
    assert sorted(map(str, again.select("doc_id", "text").collect())) == sorted(map(str, out.select("doc_id", "text").collect()))
    counted = mixing.mix(clash, tokens=F.lit(1).cast("bigint"), target_entropy=0.0, max_repeats=None)
    assert counted.count() == odd.count() and {r[0] for r in counted.select("_mix_x").collect()} == {"x"}


def test_representatives_with_clashing_names(odd):
    clash = odd.withColumns({n: F.lit("x") for n in ("_nd_i", "_nd_h", "_nd_id", "_ND_hash")})
    got, want = near_dedup.keep_representatives(clash), near_dedup.keep_representatives(odd)
    assert got.columns == clash.columns
    key = lambda df: sorted(str((r["doc_id"], r["text"])) for r in df.collect())
    assert key(got) == key(want)


def test_preferences_by_hand(spark):
    rows = [("p", 0, "user", "hi"), ("p", 1, "assistant", "yes"), ("p", 2, "user", "go"), ("p", 3, "assistant", "ok")]
    other = [("p", 0, "user", "hi"), ("p", 1, "assistant", "yes"), ("p", 2, "user", "go"), ("p", 3, "assistant", "no!")]
    more = [("q", None, None, "x"), ("q", 1, "assistant", None), (None, 1, "user", "z")]
    schema = "pair_id string, turn long, role string, text string, side string"
    c = spark.createDataFrame([r + ("?",) for r in rows + more], schema)
    r = spark.createDataFrame([x + ("?",) for x in other], schema)
    got = {x["pair_id"]: x for x in preferences.format_preferences(c, r).collect()}
    assert set(got) == {"p", "q"}
    p = got["p"]
    assert p["n_common"] == 3 and p["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\ngo<|end|>\n"
    assert p["chosen"] == "<|assistant|>\nok<|end|>\n" and p["rejected"] == "<|assistant|>\nno!<|end|>\n"
    (span,) = p["rejected_spans"]
    assert p["rejected"][span["start"] : span["stop"]] == "no!<|end|>\n"
    q = got["q"]
    assert q["prompt"] == "" and q["rejected"] == "" and q["rejected_spans"] == []
    assert q["chosen"] == "<||>\nx<|end|>\n<|assistant|>\n<|end|>\n"
    same = preferences.format_preferences(c, c).where("pair_id = 'p'").first()
    assert same["n_common"] == 4 and same["chosen"] == same["rejected"] == ""
    assert preferences.format_preferences(c.limit(0), r.limit(0)).count() == 0


def test_preferences_plan_is_native(spark):
    plan = queries.op2_preferences(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    columns, kept = docs.columns, docs
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF_CHECK).persist()
        sizes[name] = kept.count()
        if name == "quality_rules":
            want = {r["doc_id"] for r in before.collect() if not base_by_regex(r["text"])[5] and bands_by_hand(r["text"])}
            assert {r["doc_id"] for r in kept.collect()} == want
        if name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in kept.collect()} == {d for d, n, _, k in groups_by_force(rows) if k or not n}
        if name != "encoding":
            assert kept.columns == columns
    assert kept.columns == [*columns, "piece_ids"] and sizes["encoding"] == sizes["mixing"]
    assert sizes["quality_rules"] < docs.count() and sizes["near_dedup"] < sizes["quality_classifier"]


def test_pipeline_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[2:]:
            got = stage(spark, docs, SF_SMALL)
            assert got.columns[: len(docs.columns)] == docs.columns
            assert docs is not empty or got.count() == 0
            got.count()
