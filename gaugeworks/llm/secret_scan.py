"""Secret scans: fixed patterns, and guess costs of credential values.

Base spans come from three patterns (``assign``, ``access``, ``hex``).  The
method adds ``guess`` spans: every value in a credential context (a word such
as *password*, *token* or *credential* before ``:``, ``=`` or ``=>``) is cut
into segments in the cheapest way, by dynamic programming over its characters,
and is reported when an attacker would need 10^``MIN_GUESSES`` guesses or more.
The cost of a segment is the decimal logarithm of the guesses for it:

* a word of the dictionary: its rank, doubled for a capital first letter or
  all capitals, more for mixed ones; the common substitutions (``@`` for a,
  ``0`` for o, ...) count like capitals;
* a date: days of ``YEARS`` years for ``ddmmyyyy``-like forms and, with
  separators, four times as many; a year alone: ``YEARS``;
* a repeat: its unit (of at most ``MAX_PERIOD`` characters, cut by the same
  programming), times the number of copies; always a longest run of the unit;
* a keyboard walk: a longest run of at least three characters of which each
  is next to the one before on a QWERTY keyboard: the keys to start from,
  times ``WALK_TURN`` for each change of direction, times the length;
* brute force: the size of the character's class, for each character.

The dictionary is no fixed list: it holds the most frequent words of the
corpus, counted over all whole texts with the values of credential contexts
taken out (a secret in thousands of copies does not become a word).
``DICTIONARY_WORDS`` bounds what is kept and sent to the tasks.

Plan: one pass to count words (a task sends on counts, not words; the sums
are aggregated on both sides of the shuffle, so a frequent word is one row a
task), one pass to scan; nothing else is shuffled.  Whole texts, whole
values: the programming is linear in a value's length, times the bounds on
words, dates and units.

Defined cases: a NULL text is empty and has no spans; NULL ids and repeated
rows are scanned like others; an empty table gives no rows and an empty
dictionary; other columns never matter, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "guess")

# --- fixed values: the base patterns
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so the same spans as of [0-9a-f]+
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Words before a value that may be a credential (``?``-free parts for a fast look).
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "login")
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|auth)[_-]?key|credentials?|auth|bearer|login)"""
    r"""["']?[\x20\t]*(?::|=>?)[\x20\t]*["']?([^\x00-\x20"'`,;<>()\[\]{}|]+)""",
    re.IGNORECASE | re.ASCII,
)
MIN_GUESSES = 10.0

DICTIONARY_WORDS = 30_000
MIN_WORD, MAX_WORD = 3, 20
#: Words that one task counts before it sends sums on.
FLUSH = 300_000

YEARS = 150
YEAR = range(1900, 1900 + YEARS)
MAX_DATE = 10
MAX_PERIOD = 16
MIN_WALK = 3
WALK_TURN = 4
# --- fixed values: rows of a QWERTY keyboard, each shifted half a key
KEY_ROWS = ("`1234567890-=", "\tqwertyuiop[]\\", "\ta" + "sdfghjkl;'", "\tzxcvbnm,./")
SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./"))
# --- fixed values: characters that stand for letters
SUBSTITUTES = str.maketrans({"@": "a", "4": "a", "8": "b", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"})

#: Letters (bytes beyond ASCII too) to lower case, all else to blanks.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


# --- base spans ----------------------------------------------------------

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, ``(kind, start, end)`` in code points."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def context_values(text: str) -> list[tuple[int, int]]:
    """Where the values of credential contexts stand."""
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    return [m.span(1) for m in CONTEXT.finditer(text)]


# --- guess cost ----------------------------------------------------------


def _places() -> dict[str, tuple[float, int]]:
    out = {}
    for y, row in enumerate(KEY_ROWS):
        for x, key in enumerate(row):
            if key != "\t":
                out[key] = (x + y / 2, y)
    return out


PLACES = _places()


def direction(a: str, b: str) -> tuple[float, int] | None:
    """The step from key to key, if ``b`` is next to ``a``."""
    a, b = (SHIFTED.get(c, c).lower() for c in (a, b))
    if a not in PLACES or b not in PLACES or a == b:
        return None
    step = (PLACES[b][0] - PLACES[a][0], PLACES[b][1] - PLACES[a][1])
    return step if abs(step[1]) <= 1 and abs(step[0]) <= 1 else None


def walk_cost(text: str) -> float:
    steps = [direction(a, b) for a, b in zip(text, text[1:])]
    turns = sum(a != b for a, b in zip(steps, steps[1:]))
    return math.log10(len(PLACES)) + (turns + 1) * math.log10(WALK_TURN) + math.log10(len(text))


def class_size(c: str) -> int:
    if c.isascii():
        return 10 if c.isdigit() else 26 if c.isalpha() else 33
    return 100


def case_cost(word: str) -> float:
    """Guesses for the capitals and substitutes of a word."""
    letters = [c for c in word if c.isalpha()]
    capitals = sum(c.isupper() for c in letters)
    changed = len(word) - len(letters)
    cost = changed and math.log10(2 * math.comb(len(word), changed))
    if capitals:
        usual = capitals == len(letters) or (capitals == 1 and letters[0].isupper())
        cost += math.log10(2 if usual else 2 * math.comb(len(letters), capitals))
    return cost


def date_cost(text: str) -> float | None:
    """Cost of a year or a date (day, month and year in a usual order)."""
    digits = text.isascii() and text.isdigit()
    if digits and len(text) == 4 and int(text) in YEAR:
        return math.log10(YEARS)
    if digits and len(text) in (6, 8):
        n = len(text) - 4
        cuts = [(text[:n], text[n : n + 2], text[n + 2 :]), (text[:2], text[2:4], text[4:])]
        extra = 0.0
    else:
        found = re.fullmatch(r"(\d{1,4})([-/._])(\d{1,2})\2(\d{1,4})", text, re.ASCII)
        if not found:
            return None
        cuts = [(found[1], found[3], found[4])]
        extra = math.log10(4)
    for a, b, c in cuts:
        for year, x, y in ((a, b, c), (c, a, b)):
            sized = len(year) == 2 or (len(year) == 4 and int(year) in YEAR)
            if sized and len(x) <= 2 and len(y) <= 2 and 1 <= min(int(x), int(y)) <= 12 and 1 <= max(int(x), int(y)) <= 31:
                return math.log10(365 * YEARS) + extra
    return None


class GuessCost:
    """Least cost of cutting a text into segments, for one dictionary (word
    to rank, from 1)."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)

    def word_cost(self, text: str) -> float | None:
        low = text.lower()
        rank = self.ranks.get(low) or self.ranks.get(low.translate(SUBSTITUTES))
        return None if rank is None else math.log10(rank) + case_cost(text)

    def cost(self, text: str) -> float:
        n = len(text)
        best = [0.0] + [math.inf] * n
        walks = _runs([direction(a, b) is not None for a, b in zip(text, text[1:])], MIN_WALK - 1)
        repeats = self._repeats(text)
        for i in range(n):
            at = best[i]

            def offer(end: int, more: float | None) -> None:
                if more is not None and at + more < best[end]:
                    best[end] = at + more

            offer(i + 1, math.log10(class_size(text[i])))
            for end in range(i + MIN_WORD, min(n, i + self.longest) + 1):
                offer(end, self.word_cost(text[i:end]))
            if text[i].isdigit():
                for end in range(i + 4, min(n, i + MAX_DATE) + 1):
                    offer(end, date_cost(text[i:end]))
            if i in walks:
                end = walks[i] + 1
                offer(end, walk_cost(text[i:end]))
            for period, copies in repeats.get(i, ()):
                offer(i + period * copies, self._unit_cost(text[i : i + period]) + math.log10(copies))
        return best[n]

    def _unit_cost(self, unit: str) -> float:
        # a unit is shorter than the text around it, so this ends
        return self.cost(unit)

    @staticmethod
    def _repeats(text: str) -> dict[int, list[tuple[int, int]]]:
        """Longest runs of each short unit, by start: (unit length, copies)."""
        out: dict[int, list[tuple[int, int]]] = {}
        for period in range(1, min(MAX_PERIOD, len(text) // 2) + 1):
            same = [a == b for a, b in zip(text, text[period:])]
            for start, end in _runs(same, period).items():
                out.setdefault(start, []).append((period, (end - start) // period + 1))
        return out


def _runs(flags: list[bool], least: int) -> dict[int, int]:
    """Start and end of the maximal runs of at least ``least`` true flags."""
    out, start = {}, None
    for i, flag in enumerate([*flags, False]):
        if flag and start is None:
            start = i
        elif not flag and start is not None:
            if i - start >= least:
                out[start] = i
            start = None
    return out


# --- Spark ---------------------------------------------------------------


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n``: the words of all whole texts, credential values left out."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def sums() -> pa.RecordBatch:
            words = [w.decode() for w in counts]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)

        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                if not text:
                    continue
                if context_values(text):
                    text = CONTEXT.sub(" ", text)
                counts.update(w for w in text.encode().translate(_LETTERS).split() if MIN_WORD <= len(w) <= 4 * MAX_WORD)
                if len(counts) >= FLUSH:
                    yield sums()
                    counts.clear()
        yield sums()

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, "word string, n bigint")
    found = found.where(F.length("word").between(MIN_WORD, MAX_WORD))
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def fit_dictionary(docs: DataFrame, text_col: str = "text", *, words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of the corpus, the first the most frequent.

    Words are taken by steps of their count (eight to each doubling, counts of
    one left out), whole steps only and at most ``words`` in all: so the driver
    gathers the sizes of a few hundred steps and the words of the dictionary,
    however large the corpus and its partitions are."""
    counts = word_counts(docs, text_col).where("n > 1").withColumn("step", F.floor(8 * F.log2("n")).cast("int"))
    counts = written(counts, "words")
    room, least = words, None
    for r in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        if r["count"] > room:
            break
        room, least = room - r["count"], r["step"]
    if least is None:
        found = []
    else:
        found = counts.where(F.col("step") >= least).select("word", "n").collect()
    drop_written(counts)
    return [r.word for r in sorted(found, key=lambda r: (-r.n, r.word.encode()))]


RESULT = "n_assign bigint, n_access bigint, n_hex bigint, base string, spans string, costs array<double>"


def secret_spans(text: Column, dictionary: list[str], *, min_guesses: float = MIN_GUESSES) -> Column:
    """Base counts and spans, all spans, and the cost of each ``guess`` span
    (decimal logarithm of guesses, in the order of the spans), as a struct."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(pa.float64())]

    @F.arrow_udf(RESULT)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        costs = GuessCost({w: i + 1 for i, w in enumerate(dictionary)})
        cost_of = lru_cache(maxsize=4096)(costs.cost)  # copies hold equal values
        for batch in texts:
            rows = []
            for value in batch:
                text = value.as_py() or ""
                base = base_spans(text)
                found = [(a, b, cost_of(text[a:b])) for a, b in context_values(text)]
                guessed = [(("guess", a, b), c) for a, b, c in found if c >= min_guesses]
                counts = Counter(k for k, _, _ in base)
                spans = in_order(base + [s for s, _ in guessed])
                rows.append((*[counts[k] for k in BASE_KINDS], joined(base), joined(spans), [c for _, c in guessed]))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return scan(text)
