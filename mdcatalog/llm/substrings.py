"""Removal of repeated byte strings: suffixes of repeated places, a Burrows-Wheeler transform of bounded
batches, and interval expansion up to the minimum length.

A string of ``LENGTH`` bytes counts as repeated if it starts earlier too, in a document of smaller id or
earlier in the same one. Every such string picks one of its ``GRAM``-byte grams, that of the least hash, so
equal strings meet under one gram. Grams that occur once are dropped; around the others the bytes of their
strings are cut out and dealt to batches by gram. In a batch, the suffixes are ordered and transformed; the
interval of the empty string is extended backwards, breadth first, all intervals of one length at a time:
where an extension splits, the common prefix of two neighbouring suffixes is known, in increasing order of
value. At ``LENGTH`` the expansion stops, and suffixes that are still together share their string.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, cut_lineage, map_batches, mix, sized_join, small_batches, text_or_empty

LENGTH = 100
GRAM = 40
#: Bytes of a document that are hashed at a time, and of a batch that is transformed at a time.
PIECE = 1 << 20
BATCH = 1 << 20
#: Strings of a place at most.
RUN = 1_024
#: Places of one gram that are kept in one batch; more are dealt to several, whose results are merged.
PLACES = 2_048

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` bytes: a polynomial put together from runs of powers of two, and scrambled."""
    with np.errstate(over="ignore"):
        run, size, offset = mix(np.arange(1, 257, dtype=np.uint64))[data], 1, 0
        out, power = np.zeros(len(data) - length + 1, np.uint64), _BASE  # the base to the power of size
        while size <= length:
            if length & size:
                out = out * power + run[offset:offset + len(out)]
                offset += size
            if 2 * size <= length:
                run = run[:-size] * power + run[size:]
            size, power = 2 * size, power * power
        return mix(out)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    size, least = 1, values
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    n = len(values) - width + 1
    return np.minimum(least[:n], least[width - size:width - size + n])


def places(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(gram, first start, last start, how often the gram occurs: 1 or 2 for more) of runs of strings that pick the same gram.

    Only what a string holds decides its gram, so equal strings pick equal grams. Runs are cut at ``RUN`` strings.
    """
    for begin in range(0, max(0, len(text) - LENGTH + 1), PIECE):
        data = np.frombuffer(text, np.uint8, min(len(text) - begin, PIECE + LENGTH - 1), begin)
        if len(data) < LENGTH:
            continue
        hashes = gram_hashes(data, GRAM)
        width = LENGTH - GRAM + 1
        least = window_minima(hashes, width)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:] - 1, len(least) - 1]
        # where the gram stands in the run's first and last string; it occurs once if that is one place
        in_first = hashes[first[:, None] + np.arange(width)] == least[first][:, None]
        in_last = hashes[last[:, None] + np.arange(width)] == least[first][:, None]
        once = (in_first.sum(axis=1) == 1) & (in_last.sum(axis=1) == 1) & (first + in_first.argmax(axis=1) == last + in_last.argmax(axis=1))
        parts = (last - first) // RUN + 1
        owner = np.repeat(np.arange(len(first)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = first[owner] + nth * RUN
        yield (least[first].view(np.int64)[owner], start + begin, np.minimum(last[owner], start + RUN - 1) + begin, np.where(once, 1, 2).astype(np.int8)[owner])


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes of a batch by their bytes up to the next end mark, 128 at most; equal ones by place.

    ``data`` holds bytes plus one and 0 at the end marks ``ends``. Ranks by 8 bytes are doubled four times; only
    suffixes that still tie are ordered anew.
    """
    n = len(data)
    left = np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n)  # bytes before the mark
    padded = np.r_[data.astype(np.uint64), np.zeros(8, np.uint64)]
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << _U(8)) | np.where(left >= i, padded[i:i + n], _U(0))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.r_[True, (sorted_key[1:] != sorted_key[:-1]) | (left[order][1:] < 8) | (left[order][:-1] < 8)]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    size = 8
    while size < LENGTH:
        starts = np.flatnonzero(fresh)
        tied = np.flatnonzero(np.repeat(np.diff(np.r_[starts, n]) > 1, np.diff(np.r_[starts, n])))
        if not len(tied):
            break
        members = order[tied]
        pair = rank[members] * np.int64(n + 1) + rank[np.minimum(members + size, n - 1)]
        inner = np.argsort(pair, kind="stable")
        order[tied] = members[inner]
        pair, moved = pair[inner], left[order[tied]] < 2 * size
        apart = np.r_[True, (pair[1:] != pair[:-1]) | moved[1:] | moved[:-1]]
        fresh[tied] |= apart
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        size *= 2
    return order


def shared_prefixes(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, whether each begins another interval of strings of ``length`` bytes).

    Level by level: two neighbours of one interval whose preceding byte is equal stay neighbours when that byte
    is prepended, and are parted there if an interval border fell between them at the level before.
    """
    order = suffix_order(data, ends)
    n = len(order)
    transform = data[order - 1]  # the byte before each suffix; the last mark before the first
    by_byte = np.argsort(transform, kind="stable")  # where extension by a byte takes the places, in order of targets
    target = np.empty(n, np.int64)
    target[by_byte] = np.arange(n)
    same = np.r_[False, transform[by_byte][1:] == transform[by_byte][:-1]] & (transform[by_byte] != 0)
    beside = same & np.r_[False, np.diff(by_byte) == 1]  # a border at the place itself parts them
    apart = np.flatnonzero(same & ~beside)  # so does any border between the two places
    low, high = by_byte[apart - 1], by_byte[apart]
    border = ~same  # targets whose first byte differs from their neighbour's: parted at level 0
    new = np.flatnonzero(border)
    for _ in range(1, length):
        reached = target[new]
        reached = reached[beside[reached] & ~border[reached]]
        if len(apart) > n // 16:
            count = np.zeros(n, np.int32)
            count[new] = 1
            np.cumsum(count, out=count)
            cut = count[high] != count[low]
        else:
            cut = np.searchsorted(new, high, "right") != np.searchsorted(new, low, "right")
        new = np.sort(np.concatenate([reached, apart[cut]]))
        if not len(new):
            break
        border[new] = True
        if cut.any():
            apart, low, high = apart[~cut], low[~cut], high[~cut]
    return order, border


def repeated(pieces: list[bytes], counts: list[int] | np.ndarray) -> np.ndarray:
    """For every string start of every piece, in order, the number of the earliest equal one.

    Pieces are in document order; the first ``counts[i]`` starts of piece i are strings to judge.
    """
    sizes = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(sizes) - 1
    data = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # 0xff is in no UTF-8 text and becomes 0
    order, border = shared_prefixes(data, ends)
    begins = ends - sizes + 1
    judged = np.zeros(len(data), bool)
    spans = np.concatenate([np.arange(b, b + c) for b, c in zip(begins, counts)])
    judged[spans] = True
    number = np.full(len(data), len(spans))
    number[spans] = np.arange(len(spans))
    groups = np.flatnonzero(border)
    least = np.minimum.reduceat(number[order], groups)
    first = np.empty(len(data), np.int64)
    first[order] = np.repeat(least, np.diff(np.r_[groups, len(data)]))
    return first[spans]


def _places(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    out = []
    for key, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        for gram, first, last, times in places(text.encode()):
            out.append((gram, np.full(len(gram), key), first, last, times))
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["gram", "key", "first", "last", "times"])


_CUT = pa.schema([("deal", pa.int64()), ("split", pa.bool_()), ("doc_id", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("piece", pa.binary()), ("once", pa.bool_())])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of the strings of each place of a document."""
    columns: list[list] = [[] for _ in _CUT]
    for key, doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
        data = text.encode()
        for p in found:
            for column, value in zip(columns, (p["deal"], p["split"], doc, key, p["first"], data[p["first"]:p["last"] + LENGTH], p["times"] == 1)):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CUT)], schema=_CUT)


_JUDGED = "key bigint, start bigint, end bigint, string binary, doc_id bigint"


def _judge(rows: list[tuple]) -> tuple[list, list]:
    """(ranges of repeated strings, first strings of dealt-out grams) of one batch of whole groups.

    A row is (deal, split, doc_id, key, first, piece, once). Equal pieces count once: all but the first are repeated whole.
    """
    import xxhash

    rows.sort(key=lambda r: (r[2] is None, r[2] or 0, r[3], r[4]))
    ranges, kept, seen, contents = [], [], set(), Counter()
    for row in rows:
        if (row[0], row[5]) in seen:
            ranges.append((row[3], row[4], row[4] + len(row[5])))
        else:
            seen.add((row[0], row[5]))
            contents[row[0]] += 1
            kept.append(row)
    # a piece that is the only one of its gram, and holds it once, repeats nothing
    kept = [r for r in kept if r[1] or not r[6] or contents[r[0]] > 1]
    if not kept:
        return ranges, []
    pieces, counts = [r[5] for r in kept], np.array([len(r[5]) - LENGTH + 1 for r in kept])
    first = repeated(pieces, counts)
    again = first < np.arange(len(first))
    owner, before = np.repeat(np.arange(len(kept)), counts), np.cumsum(counts) - counts
    head = np.r_[True, owner[1:] != owner[:-1]]
    starts = np.flatnonzero(again & (head | ~np.r_[False, again[:-1]]))
    stops = np.flatnonzero(again & (np.r_[head[1:], True] | ~np.r_[again[1:], False]))
    keys, offsets = np.array([r[3] for r in kept]), np.array([r[4] for r in kept]) - before
    of = owner[starts]
    ranges += zip(keys[of].tolist(), (starts + offsets[of]).tolist(), (stops + offsets[of] + LENGTH).tolist())
    heads = []
    for i, (_, split, doc, key, start, piece, _) in enumerate(kept):
        if split:
            flags = again[before[i]:before[i] + counts[i]]
            heads += [(key, start + j, xxhash.xxh3_128_digest(piece[j:j + LENGTH]), doc) for j in np.flatnonzero(~flags).tolist()]
    return ranges, heads


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of ``deal``; batches are made of whole deals."""
    def flush(rows):
        ranges, heads = _judge(rows)
        n, m = len(ranges), len(heads)
        a, b, c = zip(*ranges) if n else ((), (), ())
        k, s, h, d = zip(*heads) if m else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a + k, pa.int64()), pa.array(b + s, pa.int64()), pa.array(c + (None,) * m, pa.int64()),
             pa.array((None,) * n + h, pa.binary()), pa.array((None,) * n + d, pa.int64())], names=["key", "start", "end", "string", "doc_id"])

    rows, group, weight = [], [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[-1][0] != row[0]:
                rows += group
                group = []
                if weight >= BATCH:
                    yield flush(rows)
                    rows, weight = [], 0
            group.append(row)
            weight += len(row[5])
    if rows or group:
        yield flush(rows + group)


def _strip(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Merge the ranges of each document and leave out their bytes."""
    import hashlib

    keys, removed, spans, left = [], [], [], []
    for key, text, found in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        data, at, gone, runs, kept = text.encode(), 0, 0, 0, hashlib.sha256()
        for start, end in sorted((r["start"], r["end"]) for r in found or ()):
            if start > at or not runs:
                kept.update(data[at:start])
                runs += 1
                gone += end - start
                at = end
            elif end > at:
                gone += end - at
                at = end
        kept.update(data[at:])
        keys.append(key)
        removed.append(gone)
        spans.append(runs)
        left.append(kept.hexdigest())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(left, pa.string())],
                                      names=["key", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``.

    A null text counts as empty; texts below ``LENGTH`` bytes lose nothing. Rows with equal id and text are one
    document and get equal results; different texts of one id are ordered by a hash; null ids come last.
    Other columns are ignored; an empty table gives no rows.

    Whole copies of earlier documents are found by hash and never cut up. A gram of more than ``PLACES`` places
    is dealt to several batches, and the strings that are first in their batch are merged by a 128-bit hash, so
    no task gets more than a batch. Memory follows the batch and one document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    base = base.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"), F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("bigint").alias("n_bytes"))
    copied = cut_lineage(base.where(F.col("n_bytes") >= LENGTH).groupBy("sha").agg(F.min("doc_id").alias("earliest"), F.count(F.lit(1)).alias("rows"))
                         .where(F.col("rows") > 1).select("sha", "earliest", F.lit(True).alias("many")))
    marked = sized_join(base, copied, ["sha"], "left").withColumn("copy", F.coalesce(F.col("many"), F.lit(False)) & ~F.col("doc_id").eqNullSafe(F.col("earliest")))
    heads = as_table(marked.where("many AND NOT copy").select("key", "doc_id", "text").dropDuplicates(["key"]))
    whole = marked.where(F.col("many").isNull() & (F.col("n_bytes") >= LENGTH)).select("key", "doc_id", "text").unionByName(heads)

    # grams that occur more than once
    found = map_batches(whole, _places, "gram bigint, key bigint, first bigint, last bigint, times tinyint")
    often = found.groupBy("gram").agg(F.sum("times").alias("n")).where("n > 1")
    deal = F.xxhash64("gram", F.pmod(F.xxhash64("key", "first"), F.ceil(F.col("n") / PLACES)))
    kept = found.join(often, "gram").select("key", F.struct(deal.alias("deal"), (F.col("n") > PLACES).alias("split"), "first", "last", "times").alias("place"))
    listed = kept.groupBy("key").agg(F.collect_list("place").alias("places"))  # at most one place a byte of the document
    schema = "deal bigint, split boolean, doc_id bigint, key bigint, first bigint, piece binary, once boolean"
    pieces = map_batches(whole.join(listed, "key").select("key", "doc_id", "text", "places"), _cut, schema)
    judged = pieces.repartition("deal").sortWithinPartitions("deal").mapInArrow(_search, _JUDGED)
    judged = as_table(judged)

    # strings of grams that were dealt out: all but the earliest of equal ones are repeated
    split = judged.where("string IS NOT NULL").select("string", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "start").alias("at"))
    earliest = split.groupBy("string").agg(F.min("at").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = split.join(earliest.select("string", "earliest"), "string").where("at != earliest").select(
        F.col("at.key").alias("key"), F.col("at.start").alias("start"), (F.col("at.start") + LENGTH).alias("end"))
    ranges = judged.where("string IS NULL").select("key", "start", "end").unionByName(later)
    ranges = ranges.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    stripped = map_batches(whole.join(ranges, "key").select("key", "doc_id", "text", "ranges"), _strip, "key bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    every = marked.select("doc_id", "key", "sha", "n_bytes", "copy").join(stripped, "key", "left")
    gone = lambda whole_, part: F.when(F.col("copy"), whole_).otherwise(F.coalesce(F.col(part), F.lit(0)))
    return every.select("doc_id", "n_bytes", gone(F.col("n_bytes"), "n_removed").alias("n_removed"), gone(F.lit(1), "n_spans").cast("bigint").alias("n_spans"),
                        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
