"""Personal data and secrets against plain regular expressions, and their odd rows."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mdcatalog.llm import pii, secrets
from mdcatalog.llm.queries import QUERIES
from tests.llm.helpers import SF, documents, values

AUTOMATON = secrets.automaton()


def luhn_sum(digits):
    out = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        out += d - 9 if d > 9 else d
    return out % 10 == 0


def plain_personal(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (12 <= len(digits) <= 19 and luhn_sum(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), pii.KINDS.index(kind), m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def plain_secrets(text):
    out = []
    for kind, pattern in (("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
                          ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")):
        for m in re.finditer(pattern, text, re.A):
            if len(m[1] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                out.append((m.start(), secrets.KINDS.index(kind), m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


PERSONAL = st.lists(st.sampled_from(["a@", "b.c", "@", ".", "-", "+1", "4539 1488 0343 6467", "1", "2.3.4", "999", " ", "(", ")", "é", "x_y%", "@d.e",
                                     "192.168.0.1", "+49 170 1234567", "00000255"]), max_size=14).map("".join)
SECRET = st.lists(st.sampled_from(["password", "PassWD", "api_key", "apikey", "SECRET", "token", "=", ":", " ", '"', "'", "abcdef012345", "AKIA", "AKIAABCDEFGHIJ2345",
                                   "0a1b2c3d", "deadbeef", "facade", "ABC", "K", "ſecret", "İ", "x", "."]), max_size=14).map("".join)


@given(PERSONAL)
@settings(max_examples=400, deadline=None)
def test_personal_equals_plain_search(text):
    assert [s for s in pii.find(text) if s[2] != "iban"] == plain_personal(text)


@given(SECRET)
@settings(max_examples=400, deadline=None)
def test_secrets_equal_plain_search(text):
    assert [(s, e, k) for s, e, k, _ in secrets.find(text, AUTOMATON) if k in secrets.BASE] == plain_secrets(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "0 " * 150_000):
        pii.find(text)
        secrets.find(text, AUTOMATON)


def test_iban_before_capitals():
    for account in ("GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"):
        for after in (" Please pay", " I pay", " IS MY ACCOUNT NUMBER", " A", ".", "", " 7 DE89 AND SO ON AND ON AND ON AND ON"):
            for before in ("", "to ", "DE12 "):
                text = before + account + after
                assert [text[s:e] for s, e, k in pii.find(text) if k == "iban"] == [account]
        for text in (f"x{account}", f"{account}x", account[:-1]):
            assert not [s for s in pii.find(text) if s[2] == "iban"]


def test_iban_and_context_words():
    text = "my bank account IBAN GB82 WEST 1234 5698 7654 32 OK and GB82 WEST 1234 5698 7654 33"
    spans = [s for s in pii.find(text) if s[2] == "iban"]
    assert [text[s:e] for s, e, _ in spans] == ["GB82 WEST 1234 5698 7654 32"]
    near, far = pii.score(text, *spans[0][2:], *spans[0][:2]), pii.score("x" * 60 + text[spans[0][0]:], "iban", 60, 87)
    assert near == 1.0 and far == 0.8
    assert pii.score("example card 4111", "card", 13, 17) == pytest.approx(0.7)


def test_tokens_are_kept_only_if_their_checksum_holds():
    body = "0123456789abcdefghijABCDEFGHIJ"
    good = "ghp_" + body + secrets.base62(zlib.crc32(body.encode()))
    assert [(k, c) for _, _, k, c in secrets.find(f"x {good} y", AUTOMATON) if k == "github"] == [("github", True)]
    assert not [k for _, _, k, _ in secrets.find(f"x {good[:-1]}~ ghp_{body}000000", AUTOMATON) if k == "github"]


ODD = [(1, None), (2, ""), (None, "mail a@b.c"), (3, "ü a@b.c"), (3, "ü a@b.c"), (4, "x" * 200_000 + " password=abcdefghijkl")]


def test_rows_and_digest(spark):
    found = pii.digest(pii.find_personal_data(documents(spark, ODD)))
    empty, mail = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"email:2:7").hexdigest()
    assert values(found.drop("scores")) == sorted([(1, 0, 0, 0, 0, empty, ""), (2, 0, 0, 0, 0, empty, ""), (3, 1, 0, 0, 0, mail, "email:2:7"), (3, 1, 0, 0, 0, mail, "email:2:7"),
                                    (4, 0, 0, 0, 0, empty, ""), (None, 1, 0, 0, 0, hashlib.sha256(b"email:5:10").hexdigest(), "email:5:10")], key=repr)
    secret = {r["doc_id"]: r for r in pii.digest(secrets.find_secrets(documents(spark, ODD)), secrets.BASE).collect()}
    assert secret[4]["n_assign"] == 1 and secret[4]["spans"].startswith("assign:200001:") and secret[1]["spans"] == ""
    assert [r["doc_id"] for r in secrets.without_secrets(documents(spark, ODD)).collect() if r["doc_id"] == 4] == []
    for empty_table in (documents(spark, []),):
        assert pii.find_personal_data(empty_table).count() == secrets.find_secrets(empty_table).count() == secrets.without_secrets(empty_table).count() == 0


@pytest.mark.parametrize("name, plain, kinds", [("op3_personal_data", plain_personal, pii.BASE), ("op9_secrets", plain_secrets, secrets.BASE)])
def test_query_equals_plain_search(spark, name, plain, kinds):
    expected = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        spans = plain(r["text"] or "")
        line = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
        expected[r["doc_id"]] = (*(sum(k == kind for _, _, k in spans) for kind in kinds), hashlib.sha256(line.encode()).hexdigest())
    rows = QUERIES[name](spark, SF).collect()
    assert {r["doc_id"]: (*(r[f"n_{k}"] for k in kinds), r["base_sha256"]) for r in rows} == expected and len(rows) == len(expected)


def test_scores_stand_in_the_order_of_the_spans(spark):
    text = "mail a@b.c now " + "far away " * 10 + "for example x@y.z " + "far away " * 10 + "call +1 555 123 4567 89"
    row = pii.digest(pii.find_personal_data(documents(spark, [(1, text), (2, "none")]))).orderBy("doc_id").collect()
    spans = [s.split(":") for s in row[0]["spans"].split(",")]
    assert row[0]["scores"] == ",".join(f"{pii.score(text, k, int(a), int(b)):.2f}" for k, a, b in spans) and row[1]["scores"] == ""
    assert len(set(row[0]["scores"].split(","))) > 1
