"""Row-wise operators against plain re-statements, edge cases included."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from gaugeworks.llm import language_id, piece_codec, quality_classifier, quality_rules, queries, token_shards
from gaugeworks.llm.common import held_out

from ..conftest import SF_CHECK, SF_SMALL
from .conftest import ODD

WORD = re.compile("[^\x20\x09-\x0d]+")


def base_by_regex(text):
    text = text or ""
    words = WORD.findall(text)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), symbols, dup, len(inside), failed


def bands_by_hand(text):
    raw = text.encode()
    pack = zstandard.ZstdCompressor(level=3)

    def outside(part):
        low, high = [(a, b) for least, a, b in quality_rules.BANDS if len(part) >= least][-1]
        return not low <= len(pack.compress(part)) / len(part) <= high

    parts, rest = [], raw
    while len(rest) > 4096 + 2048:
        parts.append(rest[:4096])
        rest = rest[4096:]
    parts.append(rest)
    bad = sum(len(p) for p in parts if outside(p))
    return not outside(raw) and bad <= 0.25 * len(raw)


def test_quality_rules_query(spark, docs_rows):
    got = {r["doc_id"]: r for r in queries.op7_quality_rules(spark, SF_SMALL).collect()}
    assert len(got) == len(docs_rows)
    for i, text, *_ in docs_rows:
        want, r = base_by_regex(text), got[i]
        assert tuple(r)[1:7] == want
        assert r["kept"] == (not want[5] and bands_by_hand(text))


def test_quality_rules_verdicts():
    pack = zstandard.ZstdCompressor(level=3)
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 256, 8000, dtype=np.uint8).tobytes().hex().encode() + rng.bytes(20000)
    assert quality_rules.band_verdict(b"abc " * 2000, pack)[3] is False
    assert quality_rules.band_verdict(rng.bytes(5000), pack)[3] is False
    assert quality_rules.band_verdict(noise, pack)[3] is False
    prose = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 8))) for _ in range(900)).encode()
    assert quality_rules.band_verdict(prose, pack)[3] is True
    # a third of loops in a long text is caught by the chunks alone
    assert quality_rules.band_verdict(prose * 1 + b"spam " * 900, pack)[3] is False


def test_quality_rules_odd_rows(odd, empty):
    rows = odd.select("doc_id", quality_rules.quality_rules(F.col("text")).alias("q")).select("doc_id", "q.*").collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert r["n_words"] == 0 and r["base_failed"] and not r["kept"]
    by = {r["doc_id"]: r for r in rows}
    assert by[8]["n_repeat_words"] == 60_000 and by[8]["base_failed"]
    assert by[9]["n_words"] == 40_000
    kept = quality_rules.keep_by_rules(odd)
    assert kept.columns == odd.columns
    assert quality_rules.keep_by_rules(empty).count() == 0


def test_classifier_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    rows = queries.op1_quality_classifier(spark, SF_CHECK).collect()
    assert len(rows) == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    test = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in test if y], [s for s, y in test if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9
    assert np.mean([(s >= 0.3) == bool(y) for s, y in test]) > 0.9


def test_classifier_uses_training_fold_only(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    one = quality_classifier.fit(docs, labels)
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_classifier.fit(docs, flipped) == one


def test_classifier_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(4, 1), (4, 1), (9, 0), (10, 1), (5, None), (None, 0), (6, 0), (6, 1)], "doc_id long, quality int"
    )
    model = quality_classifier.fit(odd, labels)
    rows = odd.select("doc_id", quality_classifier.quality_score(F.col("text"), model).alias("q")).collect()
    assert len(rows) == len(ODD) and all(0 <= r["q"]["score"] <= 1 for r in rows)
    blank = {r["q"]["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    none = quality_classifier.fit(empty, labels.limit(0))
    assert none.slope == 0.0 and none.offset == 0.0
    assert quality_classifier.keep_good(empty, model).columns == empty.columns


def test_language_query(spark):
    lang = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang", "text").collect()}
    rows = queries.op10_language_id(spark, SF_CHECK).collect()
    assert len(rows) == len(lang)
    known = {r["lang"] for r in lang.values()}
    for r in rows:
        text = lang[r["doc_id"]]["text"]
        blank = text is None or not any(c.isalpha() for c in text)
        assert (r["lang_pred"] == "und") == blank and (blank or r["lang_pred"] in known)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]]["lang"] for r in held]) > 0.95


def test_language_scores_equal_full_network():
    """Logits by table lookup equal averaging embeddings first."""
    rng = np.random.default_rng(2)
    table, layer = rng.normal(size=(1 << 16, 4)), rng.normal(size=(4, 3))
    model = language_id.LanguageModel(("a", "b", "c"), (table @ layer).astype(np.float32), np.zeros(3), 1.0, 0.0)
    text = "Grüße, ein Häuschen\n42 x " * 30
    idx = []
    codes = [ord(c) if c.isalpha() else 0 for c in " " + text.lower() + " "]
    for k in language_id.ORDERS:
        for i in range(len(codes) - k + 1):
            gram = codes[i : i + k]
            if any(gram) and all(gram[1:-1]):
                h = np.uint32(k)
                with np.errstate(over="ignore"):
                    for j, c in enumerate(gram):
                        h = (h ^ np.uint32(c)) * language_id._MIX[j % 4]
                        h ^= h >> np.uint32(15)
                idx.append(int(h >> np.uint32(16)))
    want = table[idx].mean(axis=0) @ layer
    assert np.allclose(language_id.raw_scores(text, model), want, atol=1e-4)


def test_language_odd_rows(odd, empty):
    model = language_id.fit(odd)
    rows = odd.select("doc_id", language_id.detect_language(F.col("text"), model).alias("d")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["doc_id"] in (1, 2, 3, 7):
            assert r["d"]["lang_pred"] == "und" and r["d"]["score"] == 0.0
    assert language_id.fit(empty) is None
    assert odd.select(language_id.detect_language(F.col("text"), None)["lang_pred"].alias("l")).distinct().collect()[0][0] == "und"


def test_copies_of_one_language_push_out_no_other(spark):
    rows = [(i, "le chat est sur la table", "fr") for i in range(2000)]
    rows += [(5000 + i, f"the dog number {i} is under a chair", "en") for i in range(300)]
    rows += [(9000, "der hund", "de"), (9001, "der hund läuft", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert set(model.languages) >= {"en", "fr"}
    got = docs.select("lang", language_id.detect_language(F.col("text"), model)["lang_pred"].alias("p")).where("lang != 'de'")
    assert got.where("lang = p").count() == 2300
    # a bound on characters leaves a text of each language
    assert set(language_id.fit(docs, max_total_chars=3).languages) == set(model.languages)


def test_every_language_is_learned(spark):
    """More than 200 languages, the rarest with six documents."""
    names = [f"l{i:03d}" for i in range(230)]
    word = lambda i: "".join(chr(0x4E00 + 40 * i + j) for j in range(4))
    rows = [(1000 * i + j, f"{word(i)} " * 8, n) for i, n in enumerate(names) for j in range(30 if i < 225 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == tuple(names)
    assert model.logits.shape == (1 << 16, language_id.DIM) and model.layer.shape == (language_id.DIM, 230)
    assert np.isfinite(language_id.raw_scores(word(229), model)).all()
    fewer = language_id.fit(docs, max_rows=230)  # a bound on the rows leaves no language out
    assert fewer.languages == tuple(names)


TOKENIZER = queries.tokenizer_path("word_bpe_49k.json")


def whole_ids(texts):
    tokenizer = token_shards.load_tokenizer(TOKENIZER)
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_query(spark, docs_rows):
    got = {r["doc_id"]: r for r in queries.op3_token_shards(spark, SF_SMALL).collect()}
    before = 0
    rows = sorted(docs_rows)
    for (i, *_), ids in zip(rows, whole_ids([r[1] for r in rows])):
        raw = np.array(ids, dtype="<u4").tobytes()
        assert tuple(got[i]) == (i, before, len(ids), zlib.crc32(raw))
        before += len(ids)


def test_words_encode_like_whole_texts():
    texts = ["  Don't\tstop…now 12,5%\n\n<|endoftext|> ", "É\u0301 ﬁ ß İ I\u0307 你好\u3000世界 a\u00a0b", "x" * 3000, "'s 's'll 're", "e\u0301 \u0301e", "J\u030c A.B, c'., 7. x.., THE,", "Y\u030a."]
    encoder = token_shards.TextEncoder(TOKENIZER, 1)
    assert encoder.by_word and encoder.folds and encoder.parts
    assert [list(map(int, ids)) for ids in encoder.encode(texts)] == whole_ids(texts)


def test_small_letters_skip_normalising():
    one = token_shards.TextEncoder(TOKENIZER, 1)
    seen = []
    one._encode_small = lambda words: seen.extend(words) or token_shards.TextEncoder._encode_small(one, words)
    texts = ["The straße ça déjà NIÑO naïve. s ll", "ÿ þ ð ø ÷ × É\u0301 e\u0301tat ﬁn ŝ", "thth" * 400 + " ænæ", "don't x1 ÀB", "déjà\u00a0vu"]
    assert [list(map(int, ids)) for ids in one.encode(texts)] == whole_ids(texts)
    assert one.letters is not None
    assert {"the", "straße", "ça", "déjà", "naïve", "s", "ll", "ÿ", "þ", "ð", "ø", "ænæ"} <= {w.decode() for w in seen}
    assert not {"÷", "×", "ŝ", "don't", "x1", "É\u0301"} & {w.decode() for w in seen}
    # a tokenizer that treats small letters on their own gets whole words
    from tokenizers import Tokenizer, normalizers

    other = Tokenizer.from_file(TOKENIZER)
    other.normalizer = normalizers.Replace("é", "e")
    assert token_shards.letters_model(other) is None


def test_words_part_from_their_marks():
    ends = ["$$$", ".%%%", "!?", "'", "'s", ",'", "...", ");", "~`", "=\u0338", "<|", "-", "_", "\\", "\u2019,", "'.s"]
    stems = ["abc", "Déjà", "x1", "it's", "a.b", "--", "É\u0301", "你好", "", "don"]
    texts = [" ".join(s + e for e in ends) for s in stems] + [f"{s}{e}" for s in stems for e in ends]
    encoder = token_shards.TextEncoder(TOKENIZER, 1)
    others = []
    encoder._encode_words = lambda words: others.extend(words) or token_shards.TextEncoder._encode_words(encoder, words)
    assert encoder.parts
    assert [list(map(int, ids)) for ids in encoder.encode(texts)] == whole_ids(texts)
    assert not {b"abc$$$", b"abc.%%%", "déjà!?".encode(), b"x1);"} & set(others)


def test_a_worker_keeps_its_encoder():
    one = token_shards.worker_encoder(TOKENIZER, 1)
    list(one.encode(["some words"]))
    two = token_shards.worker_encoder(TOKENIZER, 1)
    assert two is one and b"words" in two.table
    assert [list(map(int, ids)) for ids in two.encode(["words, Some"])] == whole_ids(["words, Some"])
    assert token_shards.worker_encoder(TOKENIZER, 2) is not one


def test_added_tokens_as_in_the_library():
    from tokenizers import Tokenizer

    texts = ["end <|endoftext|> of", "end<|endoftext|>of. The", "a <|ENDOFTEXT|> B", "<|startoftext|>É\u0301 x", "plain Text, here.", "<|EndOfText|><|endoftext|>", ""]
    want = [e.ids + [1] for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [806, 49407, 539, 1]
    encoder = token_shards.TextEncoder(TOKENIZER, 1)
    assert encoder.by_word and [list(map(int, ids)) for ids in encoder.encode(texts)] == want


def test_token_files(spark, odd, empty, tmpdir_new):
    shards = token_shards.write_token_shards(odd.repartition(3), f"file://{tmpdir_new}/t", TOKENIZER, sequence=64, batch=8)
    rows = token_shards.read_token_shards(spark, shards).collect()
    assert len(rows) == len(ODD) and rows[0]["doc_id"] is None
    want = dict(zip([r[0] for r in ODD], whole_ids([r[1] for r in ODD])))
    for _, path, n_docs, n_tokens in shards:
        reader, flat, i = token_shards.ShardReader(path), [], 0
        while len(flat) < n_tokens:
            ids, bits = reader.get(i)
            assert not ids.flags.owndata and (reader.sequence % 8 or not bits.flags.owndata)
            mask = reader.unpacked(bits)
            assert len(ids) == len(mask) == 64
            flat += ids[mask].tolist()
            i += 1
        assert len(flat) == n_tokens
        at = 0
        for batch in reader.documents():
            for doc_id, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                assert start == at and flat[start : start + n] == want[doc_id]
                at += n
    assert token_shards.write_token_shards(empty, f"file://{tmpdir_new}/e", TOKENIZER) == []
    assert token_shards.read_token_shards(spark, []).count() == 0


MODEL = queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return piece_codec.PieceVocabulary(MODEL)


def best_score(v, text):
    """Largest sum of piece scores, by plain dynamic programming."""
    text = " " + text
    best = [0.0] + [None] * len(text)
    for e in range(1, len(text) + 1):
        top = [best[s] + v.scores[text[s:e]][0] for s in range(max(0, e - v.longest), e) if text[s:e] in v.scores]
        if text[e - 1] not in v.scores:
            top.append(best[e - 1] + v.unknown)
        best[e] = max(top)
    return best[-1]


def own_score(v, ids):
    """Score of coded text; the bytes of one character count once."""
    by_id = {i: s for s, i in v.scores.values()}
    total, raw = 0.0, b""
    for i in ids:
        if i in by_id:
            total += by_id[i]
        else:
            raw += v.raw[i]
            try:
                raw.decode()
            except UnicodeDecodeError:
                continue
            total, raw = total + v.unknown, b""
    return total


def test_pieces_are_the_best_segmentation(vocabulary, docs_rows):
    codec = piece_codec.PieceCodec(vocabulary)
    texts = [t[:400] for _, t, *_ in docs_rows[:60] if t] + ["  a   b ", "你好\n\té", "x" * 300, "▁ ▁▁a", " ", "\n"]
    for t in texts:
        ids = codec.encode(t).tolist()
        assert own_score(vocabulary, ids) == best_score(vocabulary, t)
        assert codec.decode(ids) == t


def test_streaming_equals_whole(vocabulary):
    text = "thestreamingofonewordwithoutanyblank" * 200
    whole = piece_codec.StreamingViterbi(vocabulary)
    want = whole.feed(text) + whole.finish()
    for step in (1, 7, 100):
        part, got, most = piece_codec.StreamingViterbi(vocabulary), [], 0
        for i in range(0, len(text), step):
            got += part.feed(text[i : i + step])
            most = max(most, len(part.text))
        assert got + part.finish() == want
        assert most < 40 * vocabulary.longest  # only a window is held


def test_piece_query(spark, docs_rows):
    rows = queries.op6_piece_codec(spark, SF_SMALL).collect()
    assert len(rows) == len(docs_rows) and all(r["round_trip"] for r in rows)


def test_piece_odd_rows(odd, empty):
    coded = odd.withColumn("ids", piece_codec.encode_pieces(F.col("text"), MODEL))
    rows = coded.select("doc_id", "text", "ids", piece_codec.decode_pieces(F.col("ids"), MODEL).alias("back")).collect()
    assert all(r["back"] == r["text"] for r in rows)
    assert [r["ids"] for r in rows if r["doc_id"] in (1, 2)] == [None, []]
    assert empty.select(piece_codec.encode_pieces(F.col("text"), MODEL)).count() == 0
