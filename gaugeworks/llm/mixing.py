"""Mixing sources to target weights: temperature mixing.

A source with token share ``p`` gets the weight ``p ** a / sum(p ** a)``.
The exponent ``a`` in [0, 1] is found by bisection: the largest one whose
weights have at least the target entropy (as a share of the entropy of
equal weights), and, if a repetition limit is set, the smallest one at or
above it at which no source is repeated more often than that.  The limit
therefore has the last word.  Exponent 1 keeps the shares as they are and exponent 0
makes the sources equal.

A round of the bisection evaluates ``CUTS`` inner exponents at once as one
aggregation over the per-source table, so the table of sources is never
gathered in one place and a few rounds reach full precision.

The budget of tokens, times the weight, is a source's quota.  It is
realised by block permutations: the documents of a source fall into blocks
of about ``block_tokens`` tokens by a hash; pass ``e`` over a source takes
its blocks in an order that depends on the pass, and inside a block the
documents likewise.  A quota takes whole passes, then whole blocks, then
documents of the one block at the border up to the quota: a document
belongs to the mix if the tokens before it are fewer than the quota.  Only
block totals and single blocks are ever sorted together, so a source with
a third of all rows is spread over as many tasks as it has blocks.

Defined cases: a NULL source is a source of its own; a NULL text has no
tokens; documents without tokens take no part in shares, and
come once with each pass that is complete; a source without tokens gets
weight 0.  Equal rows (same id and text) are told apart by their count
only and keep their multiplicity.  NULL ids are allowed.  Ties of the hash
are broken by id and text.  The names ``_mix_*`` are used internally and
columns of the input that begin so are refused by name; all other extra
columns are carried along.  Empty tables stay empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, free_names, written

CUTS = 31
ROUNDS = 8
TARGET_ENTROPY = 0.9
MAX_REPEATS = 4.0
BLOCK_TOKENS = 2_000_000
SEED = 17


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_tokens(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    """``source, n_docs, tokens`` of every source."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(tokens).cast("bigint").alias("tokens")
    )


def solve_exponent(
    sources: DataFrame, budget: float, *, target_entropy: float | None = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS
) -> tuple[float, float]:
    """(exponent, ``log sum p ** exponent``) for a table of sources."""
    full = sources.where("tokens > 0")
    total, n = full.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not n:
        return 1.0, 0.0
    p = F.col("tokens") / F.lit(float(total))
    full = full.select(p.alias("p"), F.log(p).alias("lp"))

    def evaluate(exponents: list[float]) -> list[tuple[float, float, float]]:
        """(log of the sum, entropy, most repeats) at each exponent."""
        out = []
        for a in exponents:
            w = F.exp(F.lit(a) * F.col("lp"))
            out += [F.sum(w), F.sum(w * F.col("lp")), F.max(w / F.col("p"))]
        row = full.agg(*[c.alias(f"c{i}") for i, c in enumerate(out)]).first()
        stats = []
        for i, a in enumerate(exponents):
            z, zl, m = row[3 * i : 3 * i + 3]
            # weights are w / z; their entropy is log z - a * mean of log p
            stats.append((math.log(z), math.log(z) - a * zl / z, m / z * budget / total))
        return stats

    def bisect(holds) -> float:
        """Largest exponent of a range that begins with those that hold."""
        low, high = 0.0, 1.0
        (at_high,) = evaluate([high])
        if holds(at_high):
            return high
        for _ in range(ROUNDS):
            inner = [low + (high - low) * (i + 1) / (CUTS + 1) for i in range(CUTS)]
            good = [holds(s) for s in evaluate(inner)]
            k = good.index(False) if False in good else CUTS
            low, high = (inner[k - 1] if k else low), (inner[k] if k < CUTS else high)
        return low

    exponent = 1.0
    if target_entropy is not None:
        want = target_entropy * math.log(n)
        exponent = bisect(lambda s: s[1] >= want - 1e-12)
    if max_repeats is not None and evaluate([exponent])[0][2] > max_repeats:
        # repeats fall as the exponent rises to 1: the least exponent within the limit
        exponent = max(exponent, _raise_until(evaluate, exponent, max_repeats))
    return exponent, evaluate([exponent])[0][0]


def _raise_until(evaluate, low: float, max_repeats: float) -> float:
    high = 1.0
    for _ in range(ROUNDS):
        inner = [low + (high - low) * (i + 1) / (CUTS + 1) for i in range(CUTS)]
        good = [s[2] <= max_repeats for s in evaluate(inner)]
        k = good.index(True) if True in good else CUTS
        low, high = (inner[k - 1] if k else low), (inner[k] if k < CUTS else high)
    return high


def mixture(sources: DataFrame, budget: float, **targets) -> DataFrame:
    """The sources with ``share, weight, quota, repeats`` (quota in whole
    tokens, repeats = quota / tokens)."""
    exponent, log_sum = solve_exponent(sources, budget, **targets)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(exponent) * F.log(share) - F.lit(log_sum))).otherwise(F.lit(0.0))
    out = sources.select("source", "n_docs", "tokens", share.alias("share"), weight.alias("weight"))
    out = out.withColumn("quota", F.round(F.col("weight") * F.lit(float(budget))).cast("bigint"))
    return out.withColumn("repeats", F.when(F.col("tokens") > 0, F.col("quota") / F.col("tokens")).otherwise(0.0)).withColumn(
        "exponent", F.lit(exponent)
    )


def mix(
    docs: DataFrame,
    *,
    budget_tokens: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tokens: Column | None = None,
    target_entropy: float | None = TARGET_ENTROPY,
    max_repeats: float | None = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """The columns of ``docs`` and ``_mix_epoch, _mix_block, _mix_before``
    (pass, place of the block in the pass, tokens of the source before the
    document over all passes), one row for each use of a document.

    ``budget_tokens`` defaults to the tokens of the input.  Where ``docs`` has
    a column of one of these names, the new one has underscores behind it."""
    names = docs.columns
    if any(c.lower().startswith("_mix_") for c in names):
        plain = [f"c{i}" for i in range(len(names))]
        (extra,) = free_names(names, "c")
        held = docs if tokens is None else docs.withColumn(extra, tokens)
        inner = held.toDF(*plain, *([] if tokens is None else ["given"]))
        mixed = mix(
            inner, budget_tokens=budget_tokens, id_col=plain[names.index(id_col)], text_col=plain[names.index(text_col)],
            source_col=plain[names.index(source_col)], tokens=None if tokens is None else F.col("given"),
            target_entropy=target_entropy, max_repeats=max_repeats, block_tokens=block_tokens, seed=seed,
        )
        added = ["_mix_epoch", "_mix_block", "_mix_before"]
        return mixed.select(*plain, *added).toDF(*names, *free_names(names, *added))
    # places are found on narrow rows; texts join at the end
    count = word_tokens(F.col(text_col)) if tokens is None else tokens
    key = [F.col(id_col).alias("_mix_id"), F.xxhash64(F.col(text_col)).alias("_mix_text"), F.col(source_col).alias("_mix_source")]
    rows = docs.select(*key, count.alias("_mix_tokens"))
    # equal rows are one entry with a multiplicity, so a hot group of copies is one row
    narrow = written(
        rows.groupBy("_mix_id", "_mix_text", "_mix_source", "_mix_tokens").agg(F.count(F.lit(1)).alias("_mix_copies")),
        "mix-docs",
    )
    sources = written(
        narrow.groupBy(F.col("_mix_source").alias("source")).agg(
            F.sum("_mix_copies").alias("n_docs"), F.sum(F.col("_mix_copies") * F.col("_mix_tokens")).alias("tokens")
        ),
        "mix-sources",
    )
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    plan = mixture(sources, total if budget_tokens is None else budget_tokens, target_entropy=target_entropy, max_repeats=max_repeats)
    plan = plan.select(
        F.col("source").alias("_mix_source"),
        "tokens",
        "quota",
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(float(block_tokens)))).cast("bigint").alias("n_blocks"),
    )
    same = F.col("a._mix_source").eqNullSafe(F.col("b._mix_source"))
    placed = (
        narrow.alias("a")
        .join(plan.alias("b"), same)
        .select("a.*", "tokens", "quota", "n_blocks")
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "_mix_id", "_mix_text"), F.col("n_blocks")))
        .withColumn("all_tokens", F.col("_mix_tokens") * F.col("_mix_copies"))
    )
    blocks = placed.groupBy("_mix_source", "block", "tokens", "quota").agg(F.sum("all_tokens").alias("block_tokens"))
    # passes a source needs; a block is listed once a pass: sources x blocks x repeats rows
    passes = F.when(F.col("tokens") > 0, F.ceil(F.col("quota") / F.col("tokens"))).otherwise(0).cast("int")
    listed = (
        blocks.where("quota > 0")
        .withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0), passes - 1)))
        .withColumn("turn", F.xxhash64(F.lit(seed), "_mix_epoch", "block"))
    )
    order = Window.partitionBy("_mix_source", "_mix_epoch").orderBy("turn", "block")
    listed = listed.withColumn("_mix_block", F.row_number().over(order)).withColumn(
        "block_before",
        F.col("_mix_epoch") * F.col("tokens")
        + F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)),
    )
    listed = listed.withColumn("block_before", F.coalesce("block_before", F.col("_mix_epoch") * F.col("tokens"))).where(
        F.col("block_before") < F.col("quota")
    )
    listed = listed.select("_mix_source", "block", "_mix_epoch", "_mix_block", "block_before", "block_tokens")
    joined = (
        placed.alias("d")
        .join(
            listed.alias("l"),
            F.col("d._mix_source").eqNullSafe(F.col("l._mix_source")) & (F.col("d.block") == F.col("l.block")),
        )
        .select("d.*", "_mix_epoch", "_mix_block", "block_before", "block_tokens")
    )
    inside = Window.partitionBy("_mix_source", "_mix_epoch", "block").orderBy("turn", "_mix_id", "_mix_text")
    joined = joined.withColumn("turn", F.xxhash64(F.lit(seed), "_mix_epoch", "_mix_id", "_mix_text"))
    joined = joined.withColumn(
        "_mix_before",
        F.col("block_before")
        + F.coalesce(F.sum("all_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).where(F.col("_mix_before") < F.col("quota"))
    # copies of an entry follow one another; those that begin below the quota are used
    left = F.col("quota") - F.col("_mix_before")
    uses = F.when(F.col("_mix_tokens") > 0, F.least(F.col("_mix_copies"), F.ceil(left / F.col("_mix_tokens")))).otherwise(
        F.col("_mix_copies")
    )
    used = joined.select(
        "_mix_id", "_mix_text", "_mix_source", "_mix_epoch", "_mix_block", "_mix_before", "_mix_tokens", "_mix_copies",
        uses.cast("bigint").alias("uses"),
    )
    use = used.groupBy("_mix_id", "_mix_text", "_mix_source", "_mix_copies").agg(
        F.sort_array(
            F.collect_list(F.struct("_mix_epoch", "_mix_block", "_mix_before", "_mix_tokens", "uses"))
        ).alias("uses")
    )
    return _expand(docs, use, id_col, text_col, source_col)


def _expand(docs: DataFrame, use: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Each row of ``docs`` as often as it is used.  Copy number ``c`` of
    an entry (rows that are equal have one, by any order) is used in every
    pass that uses more than ``c`` copies."""
    columns = docs.columns
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col(id_col).alias("_mix_i"),
        F.xxhash64(F.col(text_col)).alias("_mix_t"),
        F.col(source_col).alias("_mix_s"),
    )
    on = (
        F.col("_mix_i").eqNullSafe(F.col("_mix_id"))
        & (F.col("_mix_t") == F.col("_mix_text"))
        & F.col("_mix_s").eqNullSafe(F.col("_mix_source"))
    )
    joined = keyed.join(use, on)
    single = joined.where("_mix_copies = 1").withColumn("_mix_copy", F.lit(1))
    several = joined.where("_mix_copies > 1").withColumn(
        "_mix_copy",
        F.row_number().over(Window.partitionBy("_mix_id", "_mix_text", "_mix_source").orderBy(F.lit(0))),
    )
    taken = F.filter("uses", lambda u: u["uses"] >= F.col("_mix_copy"))
    out = single.unionByName(several).withColumn("_mix_use", F.explode(taken))
    before = F.col("_mix_use._mix_before") + (F.col("_mix_copy") - 1) * F.col("_mix_use._mix_tokens")
    return out.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_mix_use._mix_epoch").alias("_mix_epoch"),
        F.col("_mix_use._mix_block").alias("_mix_block"),
        before.alias("_mix_before"),
    )
