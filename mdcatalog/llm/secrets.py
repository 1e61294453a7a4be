"""Secret scan: an Aho-Corasick automaton finds keywords, anchored expressions run only at its hits,
and tokens that carry a checksum are validated by it.

Kinds: ``assign`` (a named credential with a value), ``access`` (access key ids), ``hex`` (long runs of
hexadecimal digits), ``github`` and ``npm`` (tokens whose last six characters are a base-62 CRC-32).
Within a kind, matches are leftmost and do not overlap; failing ones are dropped and not retried inside.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
import zlib
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdcatalog.llm.common import map_batches, text_or_empty
from mdcatalog.llm.pii import digest

KINDS = ["assign", "access", "hex", "github", "npm"]
BASE = KINDS[:3]
#: Kinds that mark a document as holding a credential; a bare run of digits is reported but proves nothing.
REJECT = ["assign", "access", "github", "npm"]

# Keywords by kind, and lengths below which a match is dropped.
KEYWORDS = {"assign": ["password", "passwd", "secret", "token", "apikey", "api_key"], "access": ["akia"],
            "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], "npm": ["npm_"]}
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16

SCHEMA = "spans array<struct<kind:string,start:bigint,end:bigint,checked:boolean>>"

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_TOKEN = {"github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), "npm": re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")}
_HEX_DIGITS = frozenset("0123456789abcdef")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LOWER = {i: i + 32 for i in range(65, 91)}


def base62(number: int, width: int = 6) -> str:
    out = ""
    while number:
        number, digit = divmod(number, 62)
        out = _BASE62[digit] + out
    return out.rjust(width, "0")


def token_checks(token: str) -> bool:
    """Whether the last six characters are the base-62 CRC-32 of what stands between prefix and them."""
    body = token[token.index("_") + 1:]
    return base62(zlib.crc32(body[:-6].encode())) == body[-6:]


def automaton():
    """Keywords of all kinds. A run of 16 hexadecimal digits holds three with a decimal digit among them, or five letters."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            out.add_word(word, (kind, len(word)))
    letters, digits = "abcdef", "0123456789"
    for probe in product(letters + digits, repeat=3):
        if any(c in digits for c in probe):
            out.add_word("".join(probe), ("hex", 3))
    for probe in product(letters, repeat=5):
        out.add_word("".join(probe), ("hex", 5))
    out.make_automaton()
    return out


def find(text: str, hits) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, checked) of every secret, by start and then kind as listed; ``hits`` is the automaton."""
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose lower case is two code points
        lower = text.translate(_LOWER)
    found, done = [], dict.fromkeys(KINDS, 0)
    for last, (kind, length) in hits.iter(lower):
        start = last + 1 - length
        if start < done[kind]:
            continue
        if kind == "hex":
            first = start
            while first > done[kind] and text[first - 1] in _HEX_DIGITS:
                first -= 1
            m = _HEX.match(text, first)
            if m and m.end() > last:
                done[kind] = m.end()
                if m.end() - first >= HEX_MIN:
                    found.append((first, KINDS.index(kind), m.end(), False))
            continue
        m = (_ASSIGN if kind == "assign" else _ACCESS if kind == "access" else _TOKEN[kind]).match(text, start)
        if not m:
            continue
        if kind in _TOKEN:
            keep = token_checks(m[0])
        else:
            keep = len(m[1]) >= ASSIGN_MIN if kind == "assign" else len(m[0]) >= ACCESS_MIN
        done[kind] = m.end()
        if keep:
            found.append((start, KINDS.index(kind), m.end(), kind in _TOKEN))
    return [(s, e, KINDS[k], checked) for s, k, e, checked in sorted(found)]


def _step(batch: pa.RecordBatch, hits) -> pa.RecordBatch:
    spans = [[{"kind": k, "start": s, "end": e, "checked": c} for s, e, k, c in find(t, hits)] for t in batch.column(1).to_pylist()]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("checked", pa.bool_())]))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) per row of ``docs``, in reading order.

    A null text counts as empty and has no spans; null or repeated ids stay as they are, one result row
    per input row; other columns are ignored; an empty table gives no rows. Equal starts are ordered by
    kind as listed. Nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, _step, f"doc_id bigint, {SCHEMA}", automaton)


def _flag(batch: pa.RecordBatch, at: int, hits) -> pa.RecordBatch:
    keep = [not any(k in REJECT for _, _, k, _ in find(t or "", hits)) for t in batch.column(at).to_pylist()]
    return batch.filter(pa.array(keep, pa.bool_()))


def without_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no credential (kinds ``REJECT``), all columns as they were."""
    at = docs.columns.index(text)
    return map_batches(docs, lambda batch, hits: _flag(batch, at, hits), docs.schema, automaton)


__all__ = ["digest", "find_secrets", "without_secrets"]
