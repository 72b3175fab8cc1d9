"""SentencePiece encoding and decoding by streaming Viterbi.

The segmentation of a text into vocabulary pieces with the largest sum of
piece scores is found by dynamic programming over characters.  A text is
taken in steps of 64 times the longest piece; only ends inside the longest
piece's length ahead of the start at hand are live, and a character that no
piece covers is one edge that stands for its bytes.  Whenever the
back-pointer paths of all live ends meet on one boundary, the ids up to it
are final: they are committed and their scores forgotten.  So a step and
what has not met yet is held, never a whole text.

Boundaries that no piece of the vocabulary can cross (before a blank that
follows another character, and around a line break, in the vocabularies
here) are meeting points by construction, so a text is cut there first and
the ids of short units are remembered in a bounded table.

Ties go to the longer last piece.  Blanks are the pieces' U+2581; one
blank is put before a text and taken off again, and a U+2581 in a text is
spelled in bytes, so decoding returns every text exactly.

Per row, without a shuffle.  Defined cases: NULL encodes to NULL and
decodes to NULL, the empty text to no ids; texts are encoded whole,
however long; other columns do not matter; ids outside the vocabulary and
control ids decode to nothing, broken bytes to U+FFFD.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_PENALTY = 10.0
UNIT_TABLE = 400_000
UNIT_CHARS = 48
ROWS = 128

_NONE = float("-inf")


class PieceVocabulary:
    """Pieces, scores and byte ids of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.scores: dict[str, tuple[float, int]] = {}
        self.byte_ids = [-1] * 256
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                self.scores[text] = (model.get_score(i), i)
                self.raw[i] = text.encode("utf-8")
        self.raw_array = pa.array(self.raw, pa.binary())
        self.longest = max(map(len, self.scores), default=1)
        # children of a beginning of pieces: character to (children, score, id); id -1 where it is no piece itself
        self.root: dict[str, tuple[dict, float, int]] = {}
        for piece, (score, i) in sorted(self.scores.items()):  # a beginning comes before what it begins
            at = self.root
            for c in piece[:-1]:
                at = at.setdefault(c, ({}, 0.0, -1))[0]
            at[piece[-1]] = ({}, score, i)
        self.unknown = min((s for s, _ in self.scores.values()), default=0.0) - UNKNOWN_PENALTY
        if -1 in self.byte_ids:
            raise ValueError("the model lacks byte pieces, so not every text can be encoded")
        crossed = any(re.search(r"[^ ] ", p) for p in self.scores)
        broken = any("\n" in p for p in self.scores)
        # units end where no piece can reach across
        if crossed or broken:
            self.units = re.compile(r"[\s\S]+" if crossed else r" *[^ ]+| +")
            return
        marks = "".join(m for m in ".,;:!?" if not any(re.search(rf"[^\W_]{re.escape(m)}", p) for p in self.scores))
        more = rf"(?:[^ \n{marks}]+|(?<![^\W_])[{marks}])" if marks else r"[^ \n]"
        # a mark right after a letter or digit begins a unit
        self.units = re.compile(rf"\n| *{more}+|[^ \n]{more}*| +")


class StreamingViterbi:
    """Feed characters, take committed ids.

    ``best``, ``start`` and ``piece`` hold, for the boundaries since the
    last commit, the best score and the edge that ends there (for the rest
    of a step of ``64 * longest`` characters and for what has not met);
    ``reach`` is the last boundary with a score, at most ``longest`` after the
    one at hand.  Text is forgotten once committed."""

    def __init__(self, vocabulary: PieceVocabulary):
        self.v = vocabulary
        self._restart()

    def _restart(self) -> None:
        self.text, self.j, self.done, self.reach = "", 0, 0, 0
        self.best, self.start, self.piece = [0.0], [0], [-1]

    def feed(self, text: str) -> list[int]:
        """Add text; starts are worked off as far as whole pieces of the
        greatest length could follow them."""
        out: list[int] = []
        step = 64 * self.v.longest
        for i in range(0, len(text), step):
            new = text[i : i + step]
            self.text += new
            self.best += [_NONE] * len(new)
            self.start += [0] * len(new)
            self.piece += [-1] * len(new)
            stop = len(self.text) - self.v.longest + 1
            if stop > self.j:
                out += self._advance(stop)
                self._forget()
        return out

    def finish(self) -> list[int]:
        """The rest; afterwards a new text may begin."""
        n = len(self.text)
        out = self._advance(n)
        self._commit(n, out)
        self._restart()
        return out

    def _advance(self, stop: int) -> list[int]:
        out: list[int] = []
        s, best, start, piece, reach = self.text, self.best, self.start, self.piece, self.reach
        root, unknown, longest = self.v.root, self.v.unknown, self.v.longest
        for j in range(self.j, stop):
            if reach <= j:  # no piece reaches across j: all paths meet here
                self._commit(j, out)
                here, reach = 0.0, j + 1
            else:
                here = best[j]
                if j - self.done > 8 * longest:
                    self._commit(self._meeting(j, reach), out)
            k, children = j, root
            for c in s[j : j + longest]:
                node = children.get(c)
                if node is None:  # no piece begins like this
                    break
                k += 1
                children, score, i = node
                # a tie stays with the longer piece
                if i >= 0 and here + score > best[k]:
                    best[k], start[k], piece[k] = here + score, j, i
                    if k > reach:
                        reach = k
            # a character that is no piece itself
            node = root.get(s[j])
            if (node is None or node[2] < 0) and here + unknown > best[j + 1]:
                best[j + 1], start[j + 1], piece[j + 1] = here + unknown, j, -1
        self.j, self.reach = stop, reach
        return out

    def _meeting(self, j: int, reach: int) -> int:
        """The last boundary that the paths of all live ends share."""
        alive = {j, *(k for k in range(j + 1, reach + 1) if self.best[k] > _NONE)}
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(max(self.start[last], self.done))
        return alive.pop()

    def _commit(self, meet: int, out: list[int]) -> None:
        path, end = [], meet
        while end > self.done:
            first, i = self.start[end], self.piece[end]
            if i >= 0:
                path.append(i)
            else:
                path += [self.v.byte_ids[b] for b in reversed(self.text[first:end].encode("utf-8"))]
            end = first
        out += reversed(path)
        self.done = max(meet, self.done)

    def _forget(self) -> None:
        """Drop the committed characters and count boundaries from there."""
        d = self.done
        if d:
            self.text, self.j, self.reach, self.done = self.text[d:], self.j - d, self.reach - d, 0
            base = self.best[self.j + d]
            self.best = [x - base if x > _NONE else x for x in self.best[d:]]
            self.start = [a - d for a in self.start[d:]]
            self.piece = self.piece[d:]


class PieceCodec:
    """Whole texts to ids and back, with a table of short units.

    A full table becomes the older one, from which units in use come back."""

    def __init__(self, vocabulary: PieceVocabulary, table: int = UNIT_TABLE):
        self.v = vocabulary
        self.viterbi = StreamingViterbi(vocabulary)
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.limit = table

    def _unit(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = array("i", self.viterbi.feed(unit) + self.viterbi.finish()).tobytes()
        if len(unit) <= UNIT_CHARS:
            if len(self.table) >= self.limit:
                self.older = self.table.copy()
                self.table.clear()
            self.table[unit] = ids
        return ids

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers in native order."""
        if not text:
            return b""
        units = self.v.units.findall(" " + text)
        found = list(map(self.table.get, units))
        for at in [k for k, ids in enumerate(found) if ids is None]:
            # met earlier in this text, perhaps
            found[at] = self.table.get(units[at]) or self._unit(units[at])
        return b"".join(found)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), dtype=np.int32)

    def decode(self, ids) -> str:
        raw, n = self.v.raw, len(self.v.raw)
        ids = np.asarray(ids, dtype=np.int64)
        ids = ids[(ids >= 0) & (ids < n)]
        text = b"".join(map(raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _id_lists(texts: pa.Array, codec: PieceCodec) -> pa.ListArray:
    rows = [codec.encode_bytes(t.as_py()) if t.is_valid else b"" for t in texts]
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(rows))])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=texts.is_null())


def _texts(ids: pa.ListArray, codec: PieceCodec) -> pa.Array:
    """Decoded texts: the bytes of all pieces by one lookup, then one join a
    row; rows with unknown ids or broken UTF-8 are decoded one by one."""
    flat = ids.flatten()
    known = flat.null_count == 0 and (not len(flat) or (pc.min(flat).as_py() >= 0 and pc.max(flat).as_py() < len(codec.v.raw)))
    if known:
        ends = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False), out=ends[1:])
        spelled = pa.ListArray.from_arrays(pa.array(ends), codec.v.raw_array.take(flat), mask=ids.is_null())
        try:
            joined = pc.binary_join(spelled, pa.scalar(b"", pa.binary())).cast(pa.string())
            # the blank that encoding put before the text
            return pc.if_else(pc.starts_with(joined, " "), pc.utf8_slice_codeunits(joined, 1), joined)
        except pa.ArrowInvalid:
            pass
    return pa.array([codec.decode(r.values.drop_null().to_numpy()) if r.is_valid else None for r in ids], pa.string())


def encode_pieces(text: Column, model_path: str) -> Column:
    """Array of piece ids of a text column."""

    @F.arrow_udf("array<int>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = PieceCodec(PieceVocabulary(model_path))
        for batch in texts:
            yield _id_lists(batch, codec)

    return encode(text)


def decode_pieces(ids: Column, model_path: str) -> Column:
    """Text of a column of piece-id arrays."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = PieceCodec(PieceVocabulary(model_path))
        for batch in batches:
            yield _texts(batch, codec)

    return decode(ids)


def round_trips(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, ids, decoded`` of every row: the ids of the text and
    the text of these ids.  One worker does both, ``ROWS`` rows at a time."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(PieceVocabulary(model_path))
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                ids = _id_lists(part.column(1), codec)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), ids, _texts(ids, codec)], names=["doc_id", "text", "ids", "decoded"]
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(code, "doc_id bigint, text string, ids array<int>, decoded string")
