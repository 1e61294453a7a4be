"""Repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from mdcatalog.llm import substrings
from mdcatalog.llm.queries import QUERIES
from tests.llm.helpers import SF, documents


def brute(docs):
    """docs in order: (id, bytes, removed, runs, hash of the rest)."""
    seen, out = set(), []
    for d, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(data[p:p + 100])
        runs = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(data), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(data, gone) if not g)).hexdigest()))
    return out


def made_up(rng):
    letters = rng.choice(["ab", "abcdefgh é", "a", "the quick brown "])
    base, docs = "".join(rng.choice(letters) for _ in range(400)), []
    for d in range(rng.randint(1, 9)):
        text = ""
        for _ in range(rng.randint(0, 6)):
            kind, at = rng.random(), rng.randrange(300)
            text += (base[at:at + rng.randint(50, 260)] if kind < 0.4 else rng.choice(["ha ", "xyz", "a"]) * rng.randint(1, 200) if kind < 0.6
                     else "".join(rng.choice(letters + "mnopq") for _ in range(rng.randint(1, 200))))
        docs.append((d, text))
    return docs


def test_batches_equal_brute_force():
    """Every string is judged once, whatever texts look like: periodic, of one letter, repeated inside."""
    rng = random.Random(7)
    for _ in range(60):
        docs = made_up(rng)
        pieces = [t.encode() for _, t in docs if len(t.encode()) >= 100]
        if not pieces:
            continue
        first = substrings.repeated(pieces, [len(p) - 99 for p in pieces])
        strings = [p[i:i + 100] for p in pieces for i in range(len(p) - 99)]
        earliest = {}
        assert first.tolist() == [earliest.setdefault(s, n) for n, s in enumerate(strings)]


def test_equal_strings_pick_equal_grams():
    rng = random.Random(8)
    shared = bytes(rng.randrange(97, 123) for _ in range(300))
    grams = []
    for before in (b"", b"x" * 37, bytes(rng.randrange(97, 123) for _ in range(500))):
        each = {}
        for gram, first, last, _ in substrings.places(before + shared + before[::-1]):
            for g, f, e in zip(gram, first, last):
                each.update({p: g for p in range(f, e + 1)})
        grams.append([each[len(before) + i] for i in range(201)])
    assert grams[0] == grams[1] == grams[2]


@pytest.mark.parametrize("places", [2_048, 3])
def test_query_equals_brute_force(spark, monkeypatch, places):
    monkeypatch.setattr(substrings, "PLACES", places)
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    out = sorted(tuple(r) for r in QUERIES["op4_repeats"](spark, SF).collect())
    assert out == brute(docs)


def test_odd_rows(spark):
    line = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(150))
    rows = [(2, line), (1, line + "é"), (3, None), (4, ""), (5, "short"), (1, line + "é"), (None, line), (6, "x" * 99), (7, "x" * 99), (8, "ab" * 100_000)]
    out = {}
    for r in substrings.remove_repeats(documents(spark, rows)).collect():
        out.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"]))
    assert out == {1: [(152, 0, 0)] * 2, 2: [(150, 150, 1)], 3: [(0, 0, 0)], 4: [(0, 0, 0)], 5: [(5, 0, 0)], None: [(150, 150, 1)], 6: [(99, 0, 0)], 7: [(99, 0, 0)],
                   8: [(200_000, 200_000 - 2, 1)]} and substrings.remove_repeats(documents(spark, [])).count() == 0


def test_levels_find_exact_common_prefixes():
    text = b"mississippi$mississippi".replace(b"$", b"\xff") + b"\xff"
    data = np.frombuffer(text, np.uint8) + np.uint8(1)
    order, border = substrings.shared_prefixes(data, np.flatnonzero(data == 0), 4)
    prefix = lambda p: text[p:].split(b"\xff")[0][:4]
    for j in range(1, len(order)):
        a, b = prefix(order[j - 1]), prefix(order[j])
        assert border[j] == (a != b or len(a) < 4)
