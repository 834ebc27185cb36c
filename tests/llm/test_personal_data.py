import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from lapsewatch.llm import personal_data as pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    total = 0
    for k, c in enumerate(reversed(re.sub("[ -]", "", text))):
        total += int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c))))
    return total % 10 == 0


def good(kind, text):
    digits = sum(c in "0123456789" for c in text)
    return {"email": True, "ip": kind == "ip" and all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in text.split(".")),
            "card": 13 <= digits <= 19 and luhn(text) if kind == "card" else False, "phone": 9 <= digits <= 15}[kind]


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text) if good(k, m[0])] for k, p in PATTERNS.items()}


pieces = st.lists(st.one_of(
    st.sampled_from(["@", ".", "+", "-", " ", "1", "0", "255", "256", "4111111111111111", "4111 1111 1111 1111", "a@b.c", "x", "é", "😀",
                     "1.2.3.4", "192.168.001.9", "+1 (509) 555-6973", "(", ")", "://", "http://a.b/", "token=", "iban ", "[at]", " [dot] ", "\n", "_%"]),
    st.text(alphabet="0123456789 -+.@ab", max_size=24)), max_size=14).map("".join)


@settings(max_examples=1500, deadline=None)
@given(pieces)
def test_base_spans_equal_the_patterns(text):
    got = pii.spans_of(text, pii.anchors())
    assert {k: got[k] for k in pii.BASE} == plain(text)
    for spans in got.values():
        assert all(a < b for a, b in spans) and all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def named(text):
    return {k: [text[a:b] for a, b in v] for k, v in pii.spans_of(text, pii.anchors()).items() if v}


def test_spans_that_the_anchors_add():
    assert named("see https://user@ex.org:8080/a?b=1.") == {"url": ["https://user@ex.org:8080/a?b=1"], "email": ["user@ex.org"]}
    assert named("(http://[::1]/x), nothing://, ://a.b and 9http://c.d") == {"url": ["http://[::1]/x", "http://c.d"]}
    assert named("IBAN: DE89 3704 0044 0532 0130 00 thanks")["iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert named("IBAN GB82WEST12345698765432 X7")["iban"] == ["GB82WEST12345698765432"]
    assert "iban" not in named("IBAN: DE88 3704 0044 0532 0130 00") and "iban" not in named("DE89370400440532013000")
    assert named('token = "9f14a7029c85"')["account"] == ["9f14a7029c85"]
    assert named("Account no. 12-345-678, SSN: 123-45-6789")["account"] == ["12-345-678", "123-45-6789"]
    assert named("jane.doe [at] mail [dot] example [dot] com!") == {"written_email": ["jane.doe [at] mail [dot] example [dot] com"]}
    assert named("the account holder said hello; accountability2020x; tokens 1234567") == {}
    assert named("") == {}


def test_long_texts_take_linear_time():
    automaton, units = pii.anchors(), (
        "a", "@", "+", "1.", "9 ", "a@", "+1", "://", "a://a/", "[at]", "token ", "token.", "token=", "iban AA11", "1-", "a@b.", "+1(", "a://a@")
    for unit in units:
        assert {k: pii.spans_of(unit * 300, automaton)[k] for k in pii.BASE} == plain(unit * 300)
        began = time.process_time()
        pii.spans_of(unit * 100_000, automaton)
        assert time.process_time() - began < 5, unit


def test_rows_nulls_and_digests(spark, tmp_path):
    text = "é 😀 call +1 (509) 555-6973 or a.b@c.de from 10.0.0.1, card 4111-1111-1111-1111; token=abc12345"
    rows = [(1, text), (1, text), (2, None), (None, "x@y.zz"), (3, ""), (4, "clean " * 50_000), (5, "w" * 3_000_000 + " q@r.st")]
    df = spark.createDataFrame([(i, t, "k", [1], 2) for i, t in rows], "doc_id long, text string, kind string, spans array<int>, key int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"])
                 for r in pii.query(spark, str(tmp_path)).collect())
    want = []
    for i, t in rows:
        found = pii.spans_of(t or "", pii.anchors())
        text_of = lambda kinds: ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])  # noqa: B023, E731
        want.append((str(i), *[len(found[k]) for k in pii.BASE], hashlib.sha256(text_of(pii.BASE).encode()).hexdigest(), text_of(pii.KINDS)))
    assert got == sorted(want)
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[1] == "é 😀 call <phone> or <email> from <ip>, card <card>; token=<account>"
    assert clean[None] == "<email>" and clean[3] == "" and clean[2] is None and clean[5].endswith("w <email>")
    assert pii.find(df.limit(0)).count() == 0
