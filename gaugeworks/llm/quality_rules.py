"""Quality rules: compression bands.

Repetitive text compresses far better than prose and encoded or random
text far worse.  Every whole document, and every fixed chunk of it, is
compressed with zstandard; the ratio ``compressed / raw`` must lie inside
a band that depends on the length (a short text compresses less, as the
frame and the first occurrences weigh more).  A document is rejected when
its whole ratio leaves the band, or when chunks that leave theirs hold
more than ``max_bad_share`` of its bytes.

Base statistics (words, symbols, repeated lines and 3-word windows) come
with the verdict, and a document that fails the base rules is rejected
before the bands are looked at.

The verdict is a function of one text alone: one scan, no shuffle, nothing
collected, and the result does not depend on how rows are dealt.

Defined cases: a NULL or empty text (or one of white space only) has no
words, zero counts, NULL ratios, fails the base rules and is not kept.
Other columns never matter, whatever their names; NULL ids keep their row;
repeated rows are judged alike; an empty table gives an empty result.
Texts are processed whole, however long (one text must fit into a task).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (least bytes, lowest ratio, highest ratio) of a whole text or chunk.
#: Ordinary prose has 0.40-0.80 by length; loops fall below 0.2, base64 and
#: random bytes rise to 0.75-1.0.
BANDS = (
    (0, 0.20, 1.70),
    (64, 0.25, 1.25),
    (256, 0.28, 0.90),
    (1024, 0.25, 0.80),
    (4096, 0.22, 0.74),
    (16384, 0.20, 0.72),
)
CHUNK_BYTES = 4096
MAX_BAD_SHARE = 0.25
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, ratio double, n_chunks bigint, bad_chunk_share double, kept boolean"
)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words inside
    a 3-word window that occurs twice or more."""
    # bytes.split() divides at \x20 and \x09-\x0D and nothing else
    raw = text.encode("utf-8")
    words = raw.split()
    n = len(words)
    if not n:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0
    white = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(n)
        for i, w in enumerate(windows):
            if times[w] > 1:
                covered[i] = covered[i + 1] = covered[i + 2] = 1
        repeated = sum(covered)
    return n, len(text) - white, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def _outside(size: int, raw: int, bands) -> bool:
    low, high = next((lo, hi) for least, lo, hi in reversed(bands) if raw >= least)
    return not low * raw <= size <= high * raw


def band_verdict(raw: bytes, packer, bands=BANDS, chunk_bytes=CHUNK_BYTES, max_bad_share=MAX_BAD_SHARE):
    """(ratio, chunks, share of bytes in chunks outside their band, kept).

    A tail shorter than half a chunk joins the chunk before it."""
    n = len(raw)
    if not n:
        return None, 0, 0.0, False
    whole = len(packer.compress(raw))
    starts = list(range(0, max(n - chunk_bytes // 2, 1), chunk_bytes))
    bad = 0
    for i, s in enumerate(starts):
        e = starts[i + 1] if i + 1 < len(starts) else n
        size = whole if len(starts) == 1 else len(packer.compress(raw[s:e]))
        bad += (e - s) if _outside(size, e - s, bands) else 0
    share = bad / n
    return whole / n, len(starts), share, not _outside(whole, n, bands) and share <= max_bad_share


def quality_rules(
    text: Column,
    *,
    bands=BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    max_bad_share: float = MAX_BAD_SHARE,
    level: int = LEVEL,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> Column:
    """Statistics and verdict of a text column as one struct (``RESULT``)."""
    bands = tuple(sorted(bands))

    @F.arrow_udf(RESULT)
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=level)
        names = [f.split()[0] for f in RESULT.split(", ")]
        for batch in texts:
            rows = []
            for value in batch:
                text = value.as_py() or ""
                counts = base_counts(text)
                failed = counts[0] < min_words or 100 * counts[4] > max_repeat_percent * counts[0]
                ratio, chunks, share, inside = band_verdict(
                    text.encode("utf-8"), packer, bands, chunk_bytes, max_bad_share
                )
                rows.append((*counts, failed, ratio, chunks, share, inside and not failed))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.float64(), pa.bool_()]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return judge(text)


def keep_by_rules(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The rows whose text is kept; columns as they were."""
    return docs.where(quality_rules(F.col(text_col), **params)["kept"])
