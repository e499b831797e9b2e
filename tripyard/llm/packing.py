"""Best-fit-decreasing packing of token sequences.

Tokenising is one map pass. The tokenizer drops white space and no token spans
it, so each text is split at ASCII white space and every distinct word is
encoded once per worker (a bounded cache); tests hold this against encoding
whole texts. Only texts over the limit are cut.

Packing: pieces of full length are sequences of their own. The others are
dealt by a hash into shards of about ``SHARD_PIECES`` pieces (the number of
shards grows with the input, so a task's work does not), and each shard is
packed best-fit decreasing: a segment tree over remaining capacities finds the
tightest open sequence in logarithmic time.

Defined results: null text is empty and has the end id alone; a null id stays
null; repeated rows are packed each on its own; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm._tables import ship, staged, text_column

CAPACITY, END_ID, VOCABULARY = 2048, 0, "word_bpe_49k.json"
SHARD_PIECES, CACHE_BYTES, ENTRY_BYTES = 20_000, 48 << 20, 200

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


#: Punctuation cut off a word's end (none that the special tokens end in).
TAIL = b".,!?;:#%$*&)"


class WordIds(dict):
    """Token ids of white-space-free words as little-endian bytes.

    A new word is taken apart where the tokenizer's pattern does so anyway (a
    run of punctuation behind a letter or digit). Stems of Latin letters alone
    are lower-cased here and go straight to the merges; all others are encoded
    whole. Words and stems are kept up to CACHE_BYTES each (of stems the older
    half goes first), and until their task ends.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.model = tokenizer.encode, tokenizer.model
        self.stems: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = self.held_stems = 0

    def forget(self) -> None:
        self.clear()
        self.stems, self.older = {}, {}
        self.held = self.held_stems = 0

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(TAIL)
        if len(core) < len(word) and core and b"<|" not in word and (core[-1:].isalnum() or _latin(core)):
            found = self.stem(core) + self.stem(word[len(core):])
        else:
            found = self.stem(word)
        self.held += ENTRY_BYTES + len(word) + len(found)
        self[word] = found
        return found

    def stem(self, word: bytes) -> bytes:
        found = self.stems.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                latin = _latin(word)
                ids = [t.id for t in self.model.tokenize(latin)] if latin else self.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                found = struct.pack(f"<{len(ids)}I", *ids)
            self.held_stems += ENTRY_BYTES + len(word) + len(found)
            self.stems[word] = found
        return found

    def text(self, text: bytes) -> bytes:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        if self.held_stems > CACHE_BYTES // 2:
            self.older, self.stems = self.stems, {}
            self.held_stems = 0
        return b"".join(map(self.__getitem__, text.split()))


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level merges use for the bytes 0 to 255:
    printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def _latin(word: bytes) -> str | None:
    """The word as byte letters, lower-cased, if it is made of composed Latin
    letters alone (for these the tokenizer's steps before the merges come to
    lower case and bytes); else None."""
    if word.isalpha():  # ASCII letters
        return word.lower().decode()
    if word.isascii():
        return None
    text = word.decode("utf-8", "replace")
    if text.isalpha() and max(text) < "\u0250" and "\u0130" not in text:
        return text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
    return None


_coders: dict[str, WordIds] = {}  # a worker process serves many tasks


def _coder(vocabulary: str) -> WordIds:
    if vocabulary not in _coders:
        path = vocabulary
        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        _coders[vocabulary] = WordIds(path)
    return _coders[vocabulary]


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
              capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of every text; with ``keep_ids`` also their ids (binary,
    little-endian unsigned 32 bits)."""
    ship(docs.sparkSession)
    end = np.array([END_ID], "<u4").tobytes()
    step = 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        for batch in batches:
            ids_col, rows_col = batch.column("doc_id"), batch.column("row")
            texts = batch.column("text").cast(pa.binary())
            for at in range(0, len(batch), 512):  # a bounded number of texts' ids at once
                where, number, start, length, crc, kept = [], [], [], [], [], []
                for i in range(at, min(at + 512, len(batch))):
                    ids = coder.text(texts[i].as_py()) + end
                    for k, lo in enumerate(range(0, len(ids), step)):
                        part = ids[lo:lo + step]
                        where.append(i)
                        number.append(k)
                        start.append(lo // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            kept.append(part)
                take = pa.array(where, pa.int64())
                columns = [rows_col.take(take), ids_col.take(take), pa.array(number, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        coder.forget()  # the worker process goes on to other work

    source = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                         text_column(docs, text_col).alias("text"))
    return source.mapInArrow(pieces, PIECES + (", ids binary" if keep_ids else ""))


class Capacities:
    """Open sequences by remaining capacity, in a segment tree."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)  # 1: an open sequence below
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, left: int, sequence: int) -> None:
        self.open[left].append(sequence)
        i = left + self.size
        while i and not self.tree[i]:
            self.tree[i] = 1
            i >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out a sequence with the least capacity of ``need`` or more."""
        i, tree = need + self.size, self.tree
        if not tree[i]:
            while i > 1 and (i & 1 or not tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        left = i - self.size
        sequence = self.open[left].pop()
        if not self.open[left]:
            tree[i] = 0
            i >>= 1
            while i and not (tree[2 * i] or tree[2 * i + 1]):
                tree[i] = 0
                i >>= 1
        return left, sequence


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, best-fit decreasing."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_ones, made = Capacities(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = open_ones.tightest(n)
        if found is None:
            found, made = (capacity, made), made + 1
        left, sequence[i] = found
        offset[i] = capacity - left
        if left > n:
            open_ones.put(left - n, int(sequence[i]))
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds sequence_id and offset. Ids are odd for full pieces (one each) and
    even otherwise: shard and number within the shard."""
    ship(pieces.sparkSession)
    part = pieces.where(F.col("length") < capacity)
    shards = max(1, ceil(part.count() / shard_pieces))
    columns = pieces.columns

    def one_shard(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("piece").to_numpy(), table.column("row").to_numpy()))
        table = table.take(pa.array(order))  # the same order whichever way rows arrived
        sequence, offset = best_fit(table.column("length").to_numpy(), capacity)
        shard = table.column("shard").to_numpy().astype(np.int64)
        return pa.table([*[table.column(c) for c in columns], pa.array(((shard << 32) + sequence) * 2), pa.array(offset)],
                        [*columns, "sequence_id", "offset"])

    schema = f"{pieces.schema.simpleString()[7:-1]},sequence_id:long,offset:long"
    dealt = part.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInArrow(one_shard, schema)
    alone = pieces.where(F.col("length") >= capacity).withColumns({
        "sequence_id": F.monotonically_increasing_id() * 2 + 1, "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone)


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of ``docs`` with its place."""
    pieces = staged(tokenised(docs, id_col, text_col), "pack-pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
