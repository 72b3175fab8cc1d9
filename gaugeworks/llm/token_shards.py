"""Token-id output: Arrow stream files of fixed-size-list batches.

Documents are dealt to shards by ranges of their id, encoded, closed with
an end id, laid end to end and cut into sequences of equal length.  A
shard is two Arrow IPC files: ``*.arrow`` holds record batches with
``ids`` (fixed-size list of uint16 or uint32, by vocabulary) and ``mask``
(fixed-size list of booleans, false on the padding of the last sequence);
``*.docs.arrow`` holds ``doc_id``, ``start`` and ``n_tokens`` of each
document inside the shard.  All sequences have the same width and all
batches but the last the same number of sequences, so sequence ``i`` is
batch ``i // batch``, row ``i % batch``, read from a memory map without a
copy (``ShardReader``).

Encoding splits a text at ASCII white space and encodes every distinct
word once per block of texts.  That equals encoding whole texts for a
tokenizer that drops white space before its merges, which
``words_encode_alone`` verifies for the one in use; any other tokenizer
gets whole texts, and so does a text that holds the string of an added
token, which is that token as in the library.  Likewise A-Z are lowered first, and a new word that
ends in ASCII marks (no apostrophe) after a letter or digit is put together
from the two, where the tokenizer does so itself: fewer words are encoded then.
Words of small Latin-1 letters go to the tokenizer's model behind a plain
split at blanks (``letters_model``): normalising and splitting by pattern
leave them as they are and cost more than the merges.  A Python worker
keeps its encoder, so a task begins with the words of the one before.

Memory is bounded by one Arrow batch of texts, the words of ``ROWS`` texts, the word table (cleared at
``WORD_TABLE`` entries) and one record batch.  Files get a private name
and are moved in place when complete, so a task that runs again replaces
its file by an equal one.  The driver sees one row for each shard.

Defined cases: a NULL text is empty and yields the end id alone; NULL ids
come first; rows with equal ids are ordered by a hash of the text, and
equal rows stay as many documents as they are; an empty table writes no
shard and reads back as no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEQUENCE = 2048
BATCH = 64
ROWS = 256
WORD_TABLE = 800_000
END_ID = 1

SHARD_SCHEMA = "shard int, path string, n_docs bigint, n_tokens bigint"
DOC_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def words_encode_alone(tokenizer) -> bool:
    """True if white space only separates: a probe text (letters, digits,
    marks, contractions, repeated and leading blanks) encodes to the ids of
    its words."""
    probe = "  Don't the 'sté-你 ́x é 42 7a,b \t\n\r ## <|endoftext|> l'été 're ßİ the "
    whole = tokenizer.encode(probe, add_special_tokens=False).ids
    return whole == [i for w in probe.split() for i in tokenizer.encode(w, add_special_tokens=False).ids]


def folds_case(tokenizer) -> bool:
    probe = "ABCDEFGHIJKLM Nopqrs TUVWXYZ The THE'S aB1 É"
    return tokenizer.encode(probe, add_special_tokens=False).ids == tokenizer.encode(
        probe.encode("utf-8").lower().decode("utf-8"), add_special_tokens=False
    ).ids


#: ASCII marks but the apostrophe, which a tokenizer may take with the letters behind it.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def parts_marks(tokenizer) -> bool:
    """True if marks at the end of a word part from a letter or digit
    before them: each alone, twice, and before another one."""
    ends = [e for c in _MARKS for e in (c, c * 2, c + ".", "," + c)] + [_MARKS]
    stems = ("ab", "the", "7", "x9", "Word", "déjà", "it's", "a.b")
    whole, parted = (" ".join(f"{w}{gap}{e}" for e in ends for w in stems) for gap in ("", " "))
    one, two = tokenizer.encode_batch_fast([whole, parted], add_special_tokens=False)
    return one.ids == two.ids


#: Small letters of ASCII and Latin-1; none composes with another.
_LATIN = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_SMALL = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def letters_model(tokenizer):
    """The model behind a plain split at blanks into bytes, if words of
    small Latin-1 letters get the same ids from it (tried on the letters,
    contractions without their mark and a sixteenth of the pieces of small
    ASCII letters), else None."""
    from tokenizers import Tokenizer, pre_tokenizers

    plain = Tokenizer(tokenizer.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    pieces = sorted(set(re.findall(r"\b[a-z]+\b", " ".join(tokenizer.get_vocab()))))
    words = ["s t re ve m ll d", *_LATIN, *(f"st{c}{c}e" for c in _LATIN), _LATIN, *pieces[::16]]
    whole, alone = (t.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids for t in (tokenizer, plain))
    return plain if whole == alone else None


_MARKED = re.compile(rb"(.*(?:[A-Za-z0-9]|\xc3[\x9f-\xb6\xb8-\xbf]))([!-&(-/:-@[-`{-~]+)", re.S)


def word_ends(tokenizer) -> np.ndarray | None:
    """Which ids end a word, where the model marks that in its pieces."""
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    if not suffix:
        return None
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    ends[[i for piece, i in tokenizer.get_vocab().items() if piece.endswith(suffix)]] = True
    return ends


class TextEncoder:
    """Ids of whole texts as numpy arrays, words encoded once."""

    def __init__(self, path: str, end_id: int, table: int = WORD_TABLE):
        self.tokenizer = load_tokenizer(path)
        self.letters, self.ends = letters_model(self.tokenizer), word_ends(self.tokenizer)
        self.dtype = np.dtype("<u2") if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.dtype("<u4")
        self.by_word = words_encode_alone(self.tokenizer)
        self.folds, self.parts = folds_case(self.tokenizer), parts_marks(self.tokenizer)
        contents = {a.content.encode("utf-8") for a in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = sorted(contents | {c.lower() for c in contents})
        self.end = np.array([end_id], dtype=self.dtype).tobytes()
        self.table: dict[bytes, bytes] = {}
        self.limit = table

    def _encode(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in got]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, from one call over all of them: an id belongs
        to the word in which its offset lies."""
        texts = [w.decode("utf-8") for w in words]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(got.ids, dtype=self.dtype)
        at = np.searchsorted(np.array([a for a, _ in got.offsets], dtype=np.int64), begins)
        return [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def _encode_letters(self, words: list[bytes], tokenizer=None) -> list[bytes]:
        """The same for words of letters, without offsets: every word has
        an id that ends it, so with as many ends as words each has one."""
        if self.ends is not None:
            text = b" ".join(words).decode("utf-8")
            ids = np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            raw, at = ids.tobytes(), [0, *((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()]
            if len(at) == len(words) + 1 and at[-1] == len(raw):
                return [raw[a:b] for a, b in zip(at, at[1:])]
        return self._encode_words(words)

    def _encode_small(self, words: list[bytes]) -> list[bytes]:
        return self._encode_letters(words, self.letters)

    def _learn(self, words: set[bytes]) -> None:
        """Put words into the table, those with marks at their end as word
        and marks."""
        table = self.table
        small = [w for w in words if _SMALL.fullmatch(w)]
        rest = words.difference(small)
        marked = [m for m in map(_MARKED.fullmatch, rest) if m] if self.parts else []
        if marked:
            parts = {p for m in marked for p in m.groups()}.difference(table, words)
            stems = [w for w in parts if _SMALL.fullmatch(w)]
            small += stems
            rest = rest.difference(m[0] for m in marked) | parts.difference(stems)
        letters, others = [], []
        for w in rest:
            (letters if w.decode("utf-8").isalpha() else others).append(w)
        for kind, encode in ((small, self._encode_small), (letters, self._encode_letters), (others, self._encode_words)):
            for i in range(0, len(kind), 4096):
                part = kind[i : i + 4096]
                table.update(zip(part, encode(part)))
        for m in marked:
            table[m[0]] = table[m[1]] + table[m[2]]

    def _plain(self, raw: bytes) -> bytes:
        # some small letters compose with a combining mark (bytes CC, CD) where the capital does not
        return raw.lower() if self.folds and b"\xcc" not in raw and b"\xcd" not in raw else raw

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """One array for each text, the end id included."""
        if not self.by_word:
            for ids in self._encode(texts):
                yield np.frombuffer(ids + self.end, dtype=self.dtype)
            return
        # bytes.split() divides at ASCII white space only
        plain = [self._plain(t.encode("utf-8")) for t in texts]
        # an added token is found in the text as it is, across words and before case is folded
        whole = [i for i, t in enumerate(plain) if any(a in t for a in self.added)]
        as_whole = dict(zip(whole, self._encode([texts[i] for i in whole]))) if whole else {}
        split = [() if i in as_whole else t.split() for i, t in enumerate(plain)]
        if len(self.table) > self.limit:
            self.table.clear()
        self._learn(set(chain.from_iterable(split)).difference(self.table))
        get = self.table.__getitem__
        for i, words in enumerate(split):
            ids = as_whole[i] if i in as_whole else b"".join(map(get, words))
            yield np.frombuffer(ids + self.end, dtype=self.dtype)


@lru_cache(maxsize=1)
def worker_encoder(path: str, end_id: int) -> TextEncoder:
    """The encoder that a Python worker keeps for its next task, with the
    words it has."""
    return TextEncoder(path, end_id)


def _filesystem(uri: str):
    return pafs.FileSystem.from_uri(uri)


def _publish(fs, private: str, final: str) -> None:
    if fs.get_file_info(final).type != pafs.FileType.NotFound:
        fs.delete_file(final)
    fs.move(private, final)


def write_token_shards(
    docs: DataFrame,
    out: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    batch: int = BATCH,
) -> list[tuple]:
    """Write all documents below the folder URI ``out``; returns one tuple
    ``(shard, path, n_docs, n_tokens)`` for each shard, in order of ids."""
    fs, root = _filesystem(out)
    fs.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(out)
        encoder, shard = None, TaskContext.get().partitionId()
        private = f"{root}/.{uuid.uuid4().hex}"
        final = f"{root}/shard-{shard:06d}"
        n_docs = n_tokens = 0
        held: list[np.ndarray] = []
        n_held = 0
        block = sequence * batch
        ids_out = ids_file = docs_out = docs_file = None

        def put(ids: np.ndarray, real: int) -> None:
            mask = np.ones(len(ids), dtype=bool)
            mask[real:] = False
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(ids), sequence),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), sequence),
            ]
            ids_out.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))

        for rows in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            if encoder is None:
                encoder = worker_encoder(tokenizer_path, end_id)
                kind = pa.from_numpy_dtype(encoder.dtype)
                schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
                ids_file, docs_file = (fs.open_output_stream(private + s) for s in (".arrow", ".docs.arrow"))
                ids_out, docs_out = pa.ipc.new_file(ids_file, schema), pa.ipc.new_file(docs_file, _DOCS)
            texts = [t or "" for t in rows.column(1).to_pylist()]
            starts, lengths = [], []
            for ids in encoder.encode(texts):
                starts.append(n_tokens)
                lengths.append(len(ids))
                n_tokens += len(ids)
                held.append(ids)
                n_held += len(ids)
                if n_held >= block:
                    flat = np.concatenate(held)
                    full = n_held // block * block
                    for s in range(0, full, block):
                        put(flat[s : s + block], block)
                    held, n_held = [flat[full:]], n_held - full
            n_docs += rows.num_rows
            docs_out.write_batch(
                pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                    schema=_DOCS,
                )
            )
        if encoder is None:
            return
        if n_held:
            flat = np.concatenate(held)
            put(np.concatenate([flat, np.zeros(-n_held % sequence, dtype=encoder.dtype)]), n_held)
        for f in (ids_out, docs_out, ids_file, docs_file):
            f.close()
        for s in (".docs.arrow", ".arrow"):
            _publish(fs, private + s, final + s)
        base = out.rstrip("/") + f"/shard-{shard:06d}"
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()),
                "path": [base],
                "n_docs": pa.array([n_docs], pa.int64()),
                "n_tokens": pa.array([n_tokens], pa.int64()),
            }
        )

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    # hash and row number part rows of one id, so an id with very many rows still spreads
    dealt = picked.select("id", "text", order[1].alias("h"), order[2].alias("r"))
    dealt = dealt.repartitionByRange(F.col("id").asc_nulls_first(), "h", "r").sortWithinPartitions(
        F.col("id").asc_nulls_first(), "h", "r"
    )
    rows = dealt.select("id", "text").mapInArrow(write, SHARD_SCHEMA).collect()  # one row a shard
    return sorted(tuple(r) for r in rows)


class ShardReader:
    """Random access to one shard; local files are memory-mapped."""

    def __init__(self, base: str):
        fs, path = _filesystem(base)
        local = isinstance(fs, pafs.LocalFileSystem)
        self._open = lambda s: pa.memory_map(path + s) if local else fs.open_input_file(path + s)
        self._ids = pa.ipc.open_file(self._open(".arrow"))
        self.sequence = self._ids.schema.field("ids").type.list_size
        self.n_batches = self._ids.num_record_batches
        self._per_batch = self._ids.get_batch(0).num_rows if self.n_batches else 0

    def batch_ids(self, k: int) -> np.ndarray:
        """All ids of one batch, end to end."""
        return self._ids.get_batch(k).column(0).flatten().to_numpy(zero_copy_only=True)

    def get(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``, both as views of the file, nothing
        copied.  The mask has a bit a position, least significant first
        (``unpacked`` spells it out); where the length of a sequence is no
        multiple of 8 its bits do not begin on a byte, and the mask comes
        spelled out and packed anew."""
        rows = self._ids.get_batch(i // self._per_batch)
        first = i % self._per_batch * self.sequence
        ids = rows.column(0).flatten().to_numpy(zero_copy_only=True)[first : first + self.sequence]
        mask = rows.column(1).flatten()
        if self.sequence % 8 or mask.offset % 8:
            bits = mask[first : first + self.sequence].to_numpy(zero_copy_only=False)
            return ids, np.packbits(bits, bitorder="little")
        begin = (mask.offset + first) // 8
        return ids, np.frombuffer(mask.buffers()[1], dtype=np.uint8)[begin : begin + self.sequence // 8]

    def unpacked(self, mask: np.ndarray) -> np.ndarray:
        """A mask of ``get`` as one boolean a position."""
        return np.unpackbits(mask, count=self.sequence, bitorder="little").astype(bool)

    def documents(self) -> Iterator[pa.RecordBatch]:
        with pa.ipc.open_file(self._open(".docs.arrow")) as f:
            for k in range(f.num_record_batches):
                yield f.get_batch(k)

    def document_ids(self) -> Iterator[tuple[pa.RecordBatch, list[list[np.ndarray]]]]:
        """Batches of the index with the id pieces of each document, in
        order; one batch of ids is held at a time."""
        k, here, at = 0, np.empty(0, dtype=np.uint16), 0
        for rows in self.documents():
            pieces = []
            for n in rows.column(2).to_pylist():
                own = []
                while n:
                    if at == len(here):
                        here, at, k = self.batch_ids(k), 0, k + 1
                    take = min(n, len(here) - at)
                    own.append(here[at : at + take])
                    at, n = at + take, n - take
                pieces.append(own)
            yield rows, pieces


def read_token_shards(spark: SparkSession, shards: list[tuple]) -> DataFrame:
    """Each document of the written shards: its id, the number of ids
    before it over all shards, its own number and their CRC-32 as
    little-endian unsigned 32-bit integers.  One task a shard."""
    placed, before = [], 0
    for _, path, _, n_tokens in sorted(shards):
        placed.append((path, before))
        before += n_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for rows, pieces in ShardReader(path).document_ids():
                    sums = []
                    for own in pieces:
                        crc = 0
                        for part in own:
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    start = pa.array(rows.column(1).to_numpy() + base, pa.int64())
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": rows.column(0),
                            "start": start,
                            "n_tokens": rows.column(2),
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    paths = spark.createDataFrame(placed, "path string, base bigint")
    if placed:
        paths = paths.repartition(len(placed), "base")
    return paths.mapInArrow(read, DOC_SCHEMA)
