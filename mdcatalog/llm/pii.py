"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

Kinds: ``email``, ``ip``, ``card`` (Luhn), ``phone`` and ``iban`` (mod 97). Each expression is read
leftmost and without overlap within its kind; a proposal that its validator rejects is dropped and
not retried inside, but every country code outside a confirmed account begins one of its own. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdcatalog.llm.common import map_batches, text_or_empty

KINDS = ["email", "ip", "card", "phone", "iban"]
BASE = KINDS[:4]

# Score of a confirmed span without context, and the words that raise or lower it.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8}
RAISE = {
    "email": {"email", "mail", "contact", "reply", "write"},
    "ip": {"ip", "address", "host", "server", "login", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "payment", "cvv"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "whatsapp"},
    "iban": {"iban", "bank", "account", "transfer", "bic", "swift"},
}
LOWER = {"example", "sample", "dummy", "test", "version", "placeholder"}
CONTEXT = 48
STEP = 0.2

SCHEMA = "spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A match can only start where a run of digits starts: an earlier start in the run would match too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_GROUP = re.compile(r"\x20?[A-Z0-9]+")
_LOWER = re.compile(r"[a-z]")
_WORD = re.compile(r"[a-z]+")
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def luhn(digits: str) -> bool:
    """The Luhn check: every second digit from the right doubled, digit sums added, divisible by ten."""
    total = sum(ord(c) - 48 for c in digits[::-2]) + sum(_DOUBLED[ord(c) - 48] for c in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The IBAN check: first four characters moved to the end, letters as 10 to 35, remainder 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    out, done = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            out.append((start, done))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    ok = lambda part: len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(ok, m[0].split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]


def accounts(text: str) -> list[tuple[int, int]]:
    """Groups after the account number may look like more of it: the longest run of 15 to 34 characters that ends with a group and checks counts."""
    out, done = [], 0
    for m in _IBAN.finditer(text):
        if m.start() < done:
            continue
        whole, at, ends = m[0], m.end(), []
        while group := _GROUP.match(text, at):
            at = group.end()
            whole += group[0].lstrip(" ")
            if len(whole) > 34:
                break
            if len(whole) >= 15 and not _LOWER.match(text, at):
                ends.append((at, whole))
        for end, account in reversed(ends):
            if mod97(account):
                done = end
                out.append((m.start(), end))
                break
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, a step up for each context word of the kind nearby and a step down for each sign of an example."""
    near = set(_WORD.findall(f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}".lower()))
    return min(1.0, max(0.0, PRIOR[kind] + STEP * len(near & RAISE[kind]) - STEP * len(near & LOWER)))


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every confirmed span, by start and then kind as listed."""
    found = [(s, KINDS.index("email"), e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, search in (("ip", addresses), ("card", cards), ("phone", phones), ("iban", accounts)):
            found += [(s, KINDS.index(kind), e) for s, e in search(text)]
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def _step(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(1).to_pylist()
    spans = [[{"kind": k, "start": s, "end": e, "score": score(t, k, s, e)} for s, e, k in find(t)] for t in texts]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) per row of ``docs``: every confirmed span with its score, in reading order.

    A null text counts as empty and has no spans; null or repeated ids stay as they are, one result row
    per input row; other columns are ignored; an empty table gives no rows. Equal starts are ordered by
    kind as listed. Work and memory follow one text at a time; nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, _step, f"doc_id bigint, {SCHEMA}")


def digest(found: DataFrame, base: list[str] = BASE) -> DataFrame:
    """Counts per base kind, a hash over the base spans, all spans as text, and, if spans have scores, those in the same order."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of = lambda kind: lambda s: s["kind"] == kind
    base_spans = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", of(k))).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(F.concat_ws(",", F.transform(base_spans, line)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", line)).alias("spans"),
        *([F.concat_ws(",", F.transform("spans", lambda s: F.format_number(s["score"], 2))).alias("scores")] if "score:" in found.schema["spans"].dataType.simpleString() else []))
