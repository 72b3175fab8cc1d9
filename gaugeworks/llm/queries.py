"""The registered queries of the corpus operators.

Each applies one operator, with production parameters, to the whole of its
table.  ``SQL`` holds a DuckDB form where plain SQL can express the
outcome; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_repair,
    language_id,
    lexical_search,
    mixing,
    near_dedup,
    neighbours,
    piece_codec,
    preferences,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_shards,
    url_filter,
)
from .common import held_out, read_table, shared_dir


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; never part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules of the URL query, as (verdict, host and path).
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality_classifier.quality_score(F.col("text"), model).alias("q"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("q.score").alias("score"),
        (F.col("q.score") >= F.lit(quality_classifier.THRESHOLD)).cast("int").alias("predicted"),
        F.col("q.difference").alias("size_difference"),
    )


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    rejected = preferences.with_swapped_reply(turns)
    pairs = preferences.format_preferences(turns, rejected, pair_col="conv_id")
    return pairs.select(
        F.col("pair_id").alias("conv_id"),
        "n_chosen",
        "n_rejected",
        "n_common",
        "prompt",
        "chosen",
        "rejected",
        _spans_text("chosen_spans").alias("chosen_spans"),
        _spans_text("rejected_spans").alias("rejected_spans"),
    )


def _spans_text(spans: str):
    """Spans as text (``0-12 40-55``), so any engine compares them."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["stop"])), " ")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = shared_dir(spark, "tokens")
    shards = token_shards.write_token_shards(docs, out, tokenizer_path("word_bpe_49k.json"))
    return token_shards.read_token_shards(spark, shards)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id",
        "source",
        F.col("_mix_epoch").alias("epoch"),
        F.col("_mix_block").cast("bigint").alias("block"),
        F.col("_mix_before").alias("tokens_before"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    return piece_codec.round_trips(read_table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.length("decoded").cast("bigint").alias("n_chars"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", quality_rules.quality_rules(F.col("text")).alias("q")).select(
        "doc_id",
        *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        *[f"q.{c}" for c in ("base_failed", "kept", "ratio", "n_chunks", "bad_chunk_share")],
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    rules = [url_filter.split_rule(*r) for r in URL_RULES]
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict", "log_ratio")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    seen = docs.select("doc_id", language_id.detect_language(F.col("text"), model).alias("d"))
    return seen.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "d.lang_pred", "d.score", "d.rejected")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair_conversations(conversation_repair.damaged(turns))
    ids = turns.select("conv_id").distinct()
    joined = ids.join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(read_table(spark, sf_dir, "documents"))
    found = lexical_search.search(index, read_table(spark, sf_dir, "benchmark"))
    index.drop()
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    dictionary = secret_scan.fit_dictionary(docs)
    seen = docs.select("doc_id", secret_scan.secret_spans(F.col("text"), dictionary).alias("s"))
    return seen.select(
        "doc_id",
        *[f"s.{c}" for c in ("n_assign", "n_access", "n_hex")],
        F.sha2(F.col("s.base").cast("binary"), 256).alias("base_sha256"),
        "s.spans",
        F.col("s.costs").alias("guess_costs"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_preferences,
        op3_token_shards,
        op4_mixing,
        op5_near_dedup,
        op6_piece_codec,
        op7_quality_rules,
        op8_neighbours,
        op9_url_filter,
        op10_language_id,
        op11_conversation_repair,
        op12_lexical_search,
        op13_secret_scan,
    )
}

#: Terms of a text, as in ``lexical_search``.
_SQL_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{lexical_search.UPPER}', '{lexical_search.LOWER}'), "
    f"'{lexical_search.TERM_PATTERN}')"
)

_SQL_TURN = "'<|' || role || '|>' || chr(10) || txt || '<|end|>' || chr(10)"

SQL = {
    "op2_preferences": f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt, role AS raw_role
               FROM conversations WHERE conv_id IS NOT NULL),
lasts AS (SELECT conv_id, max(turn) AS last_turn FROM turns WHERE raw_role = 'assistant' GROUP BY conv_id),
replies AS (SELECT l.conv_id, l.last_turn, max(t.txt) AS txt FROM lasts l JOIN turns t
            ON t.conv_id = l.conv_id AND t.turn = l.last_turn AND t.raw_role = 'assistant' GROUP BY ALL),
rejected AS (
  SELECT t.conv_id, t.turn, t.role, t.txt FROM turns t LEFT JOIN lasts l USING (conv_id)
  WHERE l.last_turn IS NULL OR t.turn IS NULL OR t.turn < l.last_turn
  UNION ALL
  SELECT a.conv_id, a.last_turn, 'assistant', b.txt FROM replies a JOIN replies b ON b.conv_id = a.conv_id + 1),
sided AS (
  SELECT 'c' AS side, conv_id, role, txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt) AS pos FROM turns
  UNION ALL
  SELECT 'r', conv_id, role, txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt) FROM rejected),
sizes AS (SELECT conv_id, count(*) FILTER (side = 'c') AS n_chosen, count(*) FILTER (side = 'r') AS n_rejected
          FROM sided GROUP BY conv_id),
firsts AS (SELECT c.conv_id, min(c.pos) AS pos FROM sided c JOIN sided r
           ON c.side = 'c' AND r.side = 'r' AND c.conv_id = r.conv_id AND c.pos = r.pos
           WHERE c.role <> r.role OR c.txt <> r.txt GROUP BY c.conv_id),
p AS (SELECT s.*, CAST(coalesce(f.pos - 1, least(n_chosen, n_rejected)) AS INTEGER) AS n_common
      FROM sizes s LEFT JOIN firsts f USING (conv_id)),
texts AS (
  SELECT p.conv_id,
    coalesce(string_agg({_SQL_TURN}, '' ORDER BY pos) FILTER (side = 'c' AND pos <= n_common), '') AS prompt,
    coalesce(string_agg({_SQL_TURN}, '' ORDER BY pos) FILTER (side = 'c' AND pos > n_common), '') AS chosen,
    coalesce(string_agg({_SQL_TURN}, '' ORDER BY pos) FILTER (side = 'r' AND pos > n_common), '') AS rejected
  FROM p JOIN sided t USING (conv_id) GROUP BY p.conv_id),
marks AS (
  SELECT t.conv_id, t.side, t.pos, t.role, length(t.role) + length(t.txt) + 13 AS width,
         sum(length(t.role) + length(t.txt) + 13) OVER (PARTITION BY t.conv_id, t.side ORDER BY t.pos) AS stop
  FROM sided t JOIN p USING (conv_id) WHERE t.pos > p.n_common),
spans AS (
  SELECT conv_id, side, string_agg((stop - width + length(role) + 5) || '-' || stop, ' ' ORDER BY pos) AS spans
  FROM marks WHERE role = 'assistant' GROUP BY conv_id, side)
SELECT p.conv_id, CAST(n_chosen AS INTEGER) AS n_chosen, CAST(n_rejected AS INTEGER) AS n_rejected, n_common,
       prompt, chosen, rejected, coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM p JOIN texts USING (conv_id)
LEFT JOIN spans c ON c.conv_id = p.conv_id AND c.side = 'c'
LEFT JOIN spans r ON r.conv_id = p.conv_id AND r.side = 'r'
""",
    "op12_lexical_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS terms FROM documents),
docs AS (SELECT r, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
postings AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, corpus GROUP BY term),
items AS (SELECT DISTINCT item_id, list_sort(list_distinct({_SQL_TERMS})) AS terms FROM benchmark),
asked AS (SELECT row_number() OVER () AS q, item_id, terms FROM items),
wanted AS (SELECT q, item_id, unnest(terms) AS term FROM asked),
scores AS (SELECT q, item_id, r, doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
           FROM wanted JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
             doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""",
}
