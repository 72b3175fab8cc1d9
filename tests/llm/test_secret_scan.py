"""Secret scans against plain regular expressions and exhaustive cuts."""

import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import queries
from gaugeworks.llm import secret_scan as ss

from ..conftest import SF_SMALL

PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain(text):
    """Base spans straight from the patterns of the contract."""
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            if {"assign": lambda: len(m[1]) >= 12, "access": lambda: len(m[0]) >= 18, "hex": lambda: len(m[0]) >= 16}[kind]():
                out.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_base_spans_on_random_texts():
    rnd = random.Random(1)
    parts = ["password", "PassWd", "ſecret", "secret", "toKen", "api_key", "APIKEY", ":", "=", " ", '"', "'", "AKIA", "AKIA0123456789ABCDE"]
    parts += ["a" * 12, "0123456789abcdef", "deadbeef", "Zz9/_", "\n", "é", "日", "İ", ".", "token=", "x", "F00", "\t"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert ss.base_spans(text) == plain(text), text


WORDS = ["the", "pass", "word", "password", "dragon", "sun", "shine", "qwe"]
RANKS = {w: i + 1 for i, w in enumerate(WORDS)}


def segments(text, i, j):
    """All costs of text[i:j] as one segment, each kind by its definition."""
    s = text[i:j]
    if len(s) == 1:
        yield math.log10(10 if s in "0123456789" else 26 if s.isascii() and s.isalpha() else 33 if s.isascii() else 100)
    low = s.lower()
    plain_word = "".join({"@": "a", "4": "a", "8": "b", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}.get(c, c) for c in low)
    rank = RANKS.get(low) or RANKS.get(plain_word)
    if rank:
        yield math.log10(rank) + ss.case_cost(s)
    if ss.date_cost(s) is not None:
        yield ss.date_cost(s)

    def near(k):
        return 0 <= k < len(text) - 1 and ss.direction(text[k], text[k + 1]) is not None

    if len(s) >= 3 and all(near(k) for k in range(i, j - 1)) and not near(i - 1) and not near(j - 1):
        yield ss.walk_cost(s)
    for p in range(1, min(ss.MAX_PERIOD, len(s) // 2) + 1):
        copies = len(s) // p
        if len(s) % p or s != s[:p] * copies:
            continue
        starts_run = i == 0 or i - 1 + p >= len(text) or text[i - 1] != text[i - 1 + p]
        if starts_run and text[j : j + p] != s[:p]:
            yield exhaustive(s[:p]) + math.log10(copies)


@lru_cache(maxsize=None)
def exhaustive(text):
    """Least cost over every way to cut the text."""

    @lru_cache(maxsize=None)
    def rest(i):
        if i == len(text):
            return 0.0
        return min(c + rest(j) for j in range(i + 1, len(text) + 1) for c in segments(text, i, j))

    return rest(0)


def test_cost_equals_exhaustive_cuts():
    rnd = random.Random(2)
    parts = WORDS + ["P@ss", "DRAGON", "sUn", "1999", "24121999", "1999-12-24", "3/4/21", "aaaa", "abab", "qwerty", "zxc", "!", "ß", "7", "Kq", "asdf"]
    for n in range(600):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4)))[:22]
        assert ss.GuessCost(RANKS).cost(text) == pytest.approx(exhaustive(text)), text
    assert ss.GuessCost({}).cost("") == 0.0


def test_strong_and_weak_values():
    costs = ss.GuessCost(RANKS)
    for weak in ("password", "Passw0rd", "dragon1999", "aaaaaaaaaaaa", "qwertyuiop", "sunshine", "abcabcabcabc", "24.12.1999"):
        assert costs.cost(weak) < ss.MIN_GUESSES, weak
    for strong in ("Tr9#xLq2!vBz", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "gX7kPq92LmZt"):
        assert costs.cost(strong) >= ss.MIN_GUESSES, strong


@pytest.mark.parametrize(
    "text, value",
    [
        ("login: x\npwd = Tr9#xLq2!vBz.", "Tr9#xLq2!vBz."),
        ("Passphrase => 'zK8$wQ1&fHj3'", "zK8$wQ1&fHj3"),
        ("access-key: gX7kPq92LmZt", "gX7kPq92LmZt"),
        ("the password is not here", None),
        ("password: password", None),
        ("token = the", None),
    ],
)
def test_credential_contexts(spark, text, value):
    row = spark.createDataFrame([(text,)], "t string").select(ss.secret_spans(F.col("t"), WORDS).alias("s")).select("s.*").first()
    guesses = [s.split(":") for s in row.spans.split(",") if s.startswith("guess")]
    assert [text[int(a) : int(b)] for _, a, b in guesses] == ([value] if value else [])
    assert len(row.costs) == len(guesses) and all(c >= ss.MIN_GUESSES for c in row.costs)


def words_by_hand(texts):
    counts = Counter()
    for t in texts:
        t = (ss.CONTEXT.sub(" ", t or ""))
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c > "\x7f" or "a" <= c <= "z" else " " for c in t)
        counts.update(w for w in low.split(" ") if ss.MIN_WORD <= len(w) <= ss.MAX_WORD)
    words = [(w, n, math.floor(8 * math.log2(n))) for w, n in counts.items() if n > 1]
    steps = sorted({s for *_, s in words}, reverse=True)
    for least in steps:  # whole steps, as long as there is room
        if sum(s >= least for *_, s in words) > ss.DICTIONARY_WORDS:
            words = [x for x in words if x[2] > least]
            break
    return [w for w, *_ in sorted(words, key=lambda x: (-x[1], x[0].encode()))]


def test_query_against_plain_patterns(spark, docs_rows):
    texts = {r[0]: r[1] or "" for r in docs_rows}
    dictionary = words_by_hand(texts.values())
    assert ss.fit_dictionary(spark.read.parquet(f"{SF_SMALL}/documents.parquet")) == dictionary
    costs = ss.GuessCost({w: i + 1 for i, w in enumerate(dictionary)})
    rows = queries.op13_secret_scan(spark, SF_SMALL).collect()
    assert len(rows) == len(docs_rows)
    for r in rows:
        text = texts[r.doc_id]
        base = plain(text)
        counts = Counter(k for k, _, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert r.base_sha256 == hashlib.sha256(ss.joined(base).encode()).hexdigest()
        added = [("guess", *m.span(1)) for m in ss.CONTEXT.finditer(text) if costs.cost(m[1]) >= ss.MIN_GUESSES]
        assert r.spans == ss.joined(ss.in_order(base + added))


def test_dictionary_keeps_whole_steps_within_its_room(spark, monkeypatch):
    text = " ".join(f"w{'abcdefghij'[i]}x " * (2 if i > 3 else 40 - i) for i in range(10))
    docs = spark.createDataFrame([(text,)], "text string")
    for room in (0, 1, 3, 4, 9, 10):
        monkeypatch.setattr(ss, "DICTIONARY_WORDS", room)
        found = ss.fit_dictionary(docs, words=room)
        assert found == words_by_hand([text]) and len(found) <= room


def test_odd_rows_and_empty_table(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(ss, "FLUSH", 100)
    dictionary = ss.fit_dictionary(odd)
    assert dictionary == words_by_hand([r.text for r in odd.collect()])
    seen = odd.select("doc_id", ss.secret_spans(F.col("text"), dictionary).alias("s")).select("doc_id", "s.*")
    rows = seen.collect()
    assert len(rows) == odd.count() and all(r.spans == "" and r.n_hex == 0 for r in rows)
    assert ss.fit_dictionary(empty) == []
    assert empty.select(ss.secret_spans(F.col("text"), []).alias("s")).count() == 0


def test_copied_secret_does_not_become_a_word(spark):
    secret = "token: xqzjwvkyplmbnrtgh"
    docs = spark.createDataFrame([(secret,)] * 500 + [("some words here",)] * 3, "text string")
    dictionary = ss.fit_dictionary(docs)
    assert dictionary == ["here", "some", "words"]
    spans = docs.select(ss.secret_spans(F.col("text"), dictionary)["spans"].alias("s")).distinct().collect()
    assert {r.s for r in spans} == {"assign:0:24,guess:7:24", ""}


def test_very_long_value():
    assert ss.GuessCost(RANKS).cost("ab" * 20_000) < 10
    assert ss.GuessCost(RANKS).cost("".join(random.Random(4).choices("abcdefgh0123", k=20_000))) > 10_000
