"""Packing against the plain tokenizer, a loop that squares the counts, and the least possible number of sequences."""

import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import SF, documents, values
from tokenizers import Tokenizer

from mdcatalog.llm import packing


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def words():
    return packing.WordIds()


def ids_of(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 0]


def check_places(rows, capacity=packing.CAPACITY):
    """Every sequence is gapless from 0 and no longer than the capacity."""
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


remembered = functools.cache(packing.WordIds)
ODD = ["".join(map(chr, range(1, 0x300))), "".join(f"{chr(i)}{chr(i + 1)} " for i in range(0x3ff, 0x531)), "'S 'tis rock'n'roll's “it’s” – £3.50½ ª²", "É̈e\u0301 <|EndOfText|>", "", " ", "Hello wörld, it's 12\t3\r\n", "é ́x ΑΣ ΑΣΑ ß İ", "a\x1cb\x85c\xa0d e", "<|endoftext|> x<|startoftext|>y", "中文 字符" * 50,
       "don't we'll I'M", "﻿​z", "a\x00b", "x" * 500, "𝒳🙂 👩‍👩‍👧", " \n a \n "]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_words_are_the_ids_of_the_text(plain, words, text):
    assert np.frombuffer(words.encode(text), "<u4").tolist() == ids_of(plain, text)[:-1]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    words = remembered()
    assert np.frombuffer(words.encode(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_of_words_is_bounded(monkeypatch, plain):
    held = packing.WordIds()
    monkeypatch.setattr(packing, "WORDS", 5)
    text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))
    assert np.frombuffer(held.encode("a b " + text)[8:], "<u4").tolist() == ids_of(plain, text)[:-1]
    assert len(held.known) <= 5


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(packing._PLAIN + list("'sStTreREvelldmMD ")), max_size=80))
def test_ids_of_plain_text(text):
    test_ids_of_any_text.hypothesis.inner_test(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=60))
def test_each_place_makes_the_squares_least(lengths):
    capacity = 20
    sequence, offset = packing.place(np.array(lengths, np.int64), capacity)
    fill: dict[int, int] = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        def squares(into):
            gaps = [capacity - f for s, f in {**fill, into: fill.get(into, 0) + lengths[i]}.items()]
            return sum(gaps.count(g) ** 2 for g in set(gaps) if g)
        room = [s for s, f in fill.items() if f + lengths[i] <= capacity]
        into = int(sequence[i])
        assert offset[i] == fill.get(into, 0)
        if room:
            assert into in room and squares(into) == min(map(squares, room))
        else:
            assert into not in fill
        fill[into] = fill.get(into, 0) + lengths[i]


def test_documents_of_the_test_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs).collect()
    texts = {r["doc_id"]: ids_of(plain, r["text"]) for r in docs.collect()}
    seen: dict = {}
    for r in rows:
        ids = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and r["start"] == 2048 * r["piece"]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
    assert seen == {k: len(v) for k, v in texts.items()}
    assert check_places(rows) <= -(-sum(seen.values()) // 2048) + 1


def test_groups_are_pooled(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    docs = documents(spark, [(i % 50, "word " * (i * 37 % 700)) for i in range(600)])
    rows = packing.pack(docs).collect()
    assert len(rows) == 600
    assert check_places(rows) <= 1.03 * sum(r["length"] for r in rows) / 2048 + 1


def test_lengths_that_never_fit_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 10)
    rows = packing.pack(documents(spark, [(i, "word " * 1200) for i in range(50)])).collect()
    assert check_places(rows) == 50


def test_odd_rows(spark, plain):
    docs = documents(spark, [(1, None), (1, None), (None, ""), (2, "a b c"), (2, "a b c"), (3, "word " * 5000), (4, "word " * 2047), (5, "word " * 2048)])
    rows = packing.pack(docs).collect()
    assert check_places(rows) >= 5
    assert values(packing.pack(docs), "doc_id", "piece", "start", "length") == sorted([
        (1, 0, 0, 1), (1, 0, 0, 1), (None, 0, 0, 1), (2, 0, 0, 4), (2, 0, 0, 4), (3, 0, 0, 2048), (3, 1, 2048, 2048), (3, 2, 4096, 905),
        (4, 0, 0, 2048), (5, 0, 0, 2048), (5, 1, 2048, 1)], key=repr)
    assert packing.pack(documents(spark, [])).collect() == []


def test_tokens_of_the_sequences(spark, plain):
    docs = documents(spark, [(i, "tokens of document %d " % i * (i * 13 % 90)) for i in range(60)])
    packed = packing.pack(docs, keep_ids=True)
    rows, ids = packed.collect(), {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    texts = {r["doc_id"]: ids_of(plain, r["text"]) for r in docs.collect()}
    for r in rows:
        assert ids[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
    assert sum(map(len, ids.values())) == sum(map(len, texts.values()))


def test_another_length_and_end(spark, plain):
    rows = packing.pack(documents(spark, [(1, "a b c d e f g")]), capacity=3, end_id=7, keep_ids=True).orderBy("piece").collect()
    assert [i for r in rows for i in r["ids"]] == ids_of(plain, "a b c d e f g")[:-1] + [7]
    assert [r["length"] for r in rows] == [3, 3, 2]
