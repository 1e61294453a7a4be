"""Sum-of-squares packing of tokenized documents into sequences of one length.

Pieces are dealt at random into groups of bounded size, each packed by one task. A piece, the longest first,
goes into the open sequence where the sum of the squared counts of open sequences per residual gap becomes
smallest, and opens a sequence only where none has room. What ends in sequences with room to spare is pooled
and packed again, so that the groups' last sequences do not stay behind half empty.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, map_batches, text_or_empty

#: Tokens of a sequence, and the token after every document.
CAPACITY = 2_048
END_ID = 0
#: File of the public tokenizers that is used unless a path is given.
VOCABULARY = "word_bpe_49k.json"
#: Pieces that one task packs, on average.
GROUP = 16_384
#: Sequences with more room than this part of their length are packed again.
LOOSE = 0.01
#: Words of which a worker remembers the ids.
WORDS = 300_000

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _plain_characters() -> list[str]:
    """Characters that neither combine nor decompose and whose lower case is one of them: Latin, Cyrillic, general punctuation."""
    ranges = [(0x00, 0x24F), (0x400, 0x481), (0x48A, 0x52F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF)]
    all_ = {chr(c) for a, b in ranges for c in range(a, b + 1)}
    return sorted(c for c in all_ if c.lower() in all_)


def _class(characters: list[str]) -> str:
    return "".join(re.escape(c) for c in characters)


_PLAIN = _plain_characters()
_LETTERS = [c for c in _PLAIN if unicodedata.category(c)[0] == "L"]
_NUMBERS = [c for c in _PLAIN if unicodedata.category(c)[0] == "N"]
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"
_OTHERS = [c for c in _PLAIN if c not in _SPACES and unicodedata.category(c)[0] not in "LN"]
_IS_PLAIN = re.compile(f"[{_class(_PLAIN)}]*")
# How the vocabulary cuts normalised text into words.
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class(_LETTERS)}]+|[{_class(_NUMBERS)}]|[{_class(_OTHERS)}]+")

# The character that stands for each byte; printable ones stand for themselves, the rest follow from 256 on.
_OWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTES = dict(zip((b for b in range(256) if b not in _OWN), range(256, 512)))


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers; those of words are remembered while the memory stays small.

    The vocabulary's words end at white space at the latest and nothing is normalised across it, so the ids
    of a text are those of its words. Plain texts are cut as the vocabulary cuts them, which gives fewer
    different words; others, and those with what may be a special token, at white space.
    """

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are taken by other tasks
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.known: dict[str, bytes] = {"": b""}
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize

    def _ids(self, words: list[str], plain: bool) -> Iterator[list[int]]:
        if not plain:
            return (x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False))
        # words as the vocabulary cuts them need only its merges, over a character a byte
        return ([t.id for t in self.merge(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(_BYTES))] for w in words)

    def encode(self, text: str) -> bytes:
        plain = _IS_PLAIN.fullmatch(text) and "<|" not in text
        words = _WORDS.findall(text.lower()) if plain else text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self.known
        different = set(words)
        new = [word for word in different if word not in known]
        if new:
            ids = {word: struct.pack(f"<{len(x)}I", *x) for word, x in zip(new, self._ids(new, plain))}
            if len(known) + len(new) > WORDS:  # the commonest words came first
                known = {word: ids[word] if word in ids else known[word] for word in different}
            else:
                known.update(ids)
        return b"".join(map(known.__getitem__, words))


def tokenize(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None,
             keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) per piece of at most ``capacity`` tokens, without a shuffle.

    A null or empty text is the end token alone. Null and repeated ids stay as they are, each row is a document
    of its own; other columns are ignored; an empty table gives no rows. ``vocabulary`` is a path that every
    task can open.
    """
    end = np.array([end_id], "<u4").tobytes()
    step_bytes = 4 * capacity

    def cut(batch: pa.RecordBatch, words: WordIds) -> pa.RecordBatch:
        rows: list[tuple] = []
        for own, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = words.encode(content) + end
            for piece, at in enumerate(range(0, len(ids), step_bytes)):
                part = ids[at:at + step_bytes]
                rows.append((own, piece, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4") if keep_ids else None))
        columns = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays(arrays if keep_ids else arrays[:5], names=names if keep_ids else names[:5])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, cut, _PIECE + (", ids array<int>" if keep_ids else ""), lambda: WordIds(vocabulary))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length by sum-of-squares placement, the longest first; none is above ``capacity``."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences per gap; gaps 0 and ``capacity`` are never open
    open_: dict[int, list[int]] = {}
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        had = count[size:capacity]
        # the sum of squares grows by 2 (after - before) + 2; a sequence that becomes full leaves the counts
        growth = 2 * (count[:capacity - size] - had) + 2
        if len(growth):
            growth[0] = 1 - 2 * had[0]
            growth[had == 0] = np.iinfo(np.int64).max
        left = int(growth.argmin()) if len(growth) else -1
        if left >= 0 and had[left]:
            gap = size + left
            into = open_[gap].pop()
            count[gap] -= 1
        else:
            gap, left, into = capacity, capacity - size, used
            used += 1
        sequence[i], offset[i] = into, capacity - gap
        if left:
            open_.setdefault(left, []).append(into)
            count[left] += 1
    return sequence, offset


def _pack(pieces: DataFrame, count: int, capacity: int, number: int) -> tuple[DataFrame, int]:
    """``pieces`` with (sequence_id, offset, room) as a table, and the number of groups; ``number`` tells rounds apart."""
    groups = max(1, -(-count // GROUP))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending")])
        lengths = table.column("length").to_numpy()
        sequence, offset = place(lengths, capacity)
        room = capacity - np.bincount(sequence, lengths, minlength=1).astype(np.int64)[sequence]
        ids = (number << 56) + (key[0].as_py() << 24) + sequence
        return table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset)).append_column("room", pa.array(room))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    dealt = pieces.withColumn("unit", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)))
    packed = dealt.repartition(groups, "unit").groupBy("unit").applyInArrow(run, f"{schema}, unit bigint, sequence_id bigint, offset bigint, room bigint")
    return as_table(packed.drop("unit")), groups


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None,
         keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) per piece of every document.

    Only documents of more than ``capacity`` tokens are cut; pieces of exactly that length are sequences of
    their own. Null and empty texts, null and repeated ids and further columns are treated as in ``tokenize``;
    equal rows are packed as often as they occur; an empty table gives no rows. Rows are dealt by their place
    in the table, so neither an id nor a length that a third of them share gathers in one task.
    """
    pieces = as_table(tokenize(docs, capacity, end_id, vocabulary, keep_ids, doc_id, text).withColumn("row", F.monotonically_increasing_id()))
    whole = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("bigint"))
    settled, rest, number = [whole], pieces.where(F.col("length") < capacity), 0
    count = rest.count()
    while True:
        packed, groups = _pack(rest, count, capacity, number)
        loose = packed.where(F.col("room") > int(LOOSE * capacity))
        left = loose.count() if groups > 1 else 0
        if not left or number and 2 * left > count:  # nothing to gain from yet another deal
            settled.append(packed.drop("room"))
            break
        settled.append(packed.where(F.col("room") <= int(LOOSE * capacity)).drop("room"))
        rest, count, number = loose.drop("sequence_id", "offset", "room"), left, number + 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the tokens of each sequence of ``pack(…, keep_ids=True)``, pieces in the order of their offsets."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda p: p["ids"])).alias("ids"))
