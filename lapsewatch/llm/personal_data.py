"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs, digits, schemes, written-out
at-signs and cues of identifiers. A small deterministic parser for each kind expands an anchor to the boundaries of
what it may belong to and validates it. Parsers never look back before the end of the previous find of their
kind, so a text takes time in proportion to its length. Positions are code points, ends exclusive.

Four kinds are the base, defined by patterns (leftmost, not overlapping, failing candidates dropped):

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``     four runs of digits joined by dots, each at most 255
* ``card``   digits, each after at most one space or hyphen; 13 to 19 digits with a valid Luhn sum
* ``phone``  ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 9 to 15 digits

The anchors add four kinds, which never replace those: ``url`` (a scheme, ``://``, a host with a dot or a bracket, no
closing punctuation), ``iban`` (behind its cue, valid by the remainder modulo 97), ``account`` (behind a cue: an identifier of
at least six letters and digits, two of them digits) and ``written_email`` (``name [at] host [dot] com``).
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table
from .texts import pieces

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "written_email")
# Cues in front of identifiers, and written-out at-signs. Cues count in lower, upper and title case.
CUES = (
    "account", "acct", "api key", "api_key", "apikey", "customer id", "customer no", "login", "member id", "member no",
    "passport", "password", "patient id", "secret", "social security", "ssn", "tax id", "token", "user id", "user_id", "username")
IBAN_CUES = ("iban",)
WRITTEN_AT = ("[at]", "(at)", "{at}")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPACED = re.compile(r"[0-9](?:[ -]?[0-9])*")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ADDRESS = re.compile(r"://(?:[^\s/?#\"'<>\\^`{|}]*@)?(?:\[[0-9A-Fa-f:.]+\]|[^\W_](?:[\w.-]*[^\W_])?)(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>\\^`{|}]*)?")
AFTER_CUE = re.compile(r"(?:[ _-](?:number|num|no|nr|id|key))?\.?\s{0,3}(?:is\s|[:=#])?\s{0,3}[\"']?([A-Za-z0-9](?:[A-Za-z0-9._/-]*[A-Za-z0-9])?)")
AFTER_IBAN = re.compile(r"(?:[ _-](?:number|no))?\.?\s{0,3}[:=#]?\s{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
WRITTEN_HOST = re.compile(r"\s?([A-Za-z0-9-]+(?:\s?(?:\[dot\]|\(dot\)|\{dot\}|\.)\s?[A-Za-z0-9-]+)+)")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")

Span = tuple[int, int]


def anchors() -> ahocorasick.Automaton:
    """The automaton; a hit carries the anchor's kind and length."""
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for kind, words in (("at", ("@",)), ("plus", ("+",)), ("scheme", ("://",)), ("iban", IBAN_CUES), ("cue", CUES), ("written", WRITTEN_AT)):
        for word in words:
            for form in {word, word.upper(), word.title(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _left(text: str, end: int, allowed: frozenset, least: int) -> int:
    """Start of the run of allowed characters that ends at ``end``, not before ``least``."""
    at = end
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _quads(chain: str, start: int):
    """Each four runs of a dotted chain."""
    runs, at = chain.split("."), start
    for i in range(0, len(runs) - 3, 4):
        four = runs[i:i + 4]
        size = sum(map(len, four)) + 3
        if all(len(r.lstrip("0")) <= 3 and int(r[-3:]) <= 255 for r in four):
            yield at, at + size
        at += size + 1


def _iban(text: str, start: int, end: int) -> Span | None:
    """The longest valid number that starts at ``start``."""
    while end - start >= 15:
        number = text[start:end].replace(" ", "")
        if 15 <= len(number) <= 34 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
            return start, end
        end = _left(text, end - 1, frozenset(" "), start)
    return None


def spans_of(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[Span]]:
    """Spans by kind, each list by start and free of overlaps."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    over = dict.fromkeys(("email", "dotted", "spaced", "phone", "url", "iban", "account", "written_email"), 0)

    def keep(kind: str, start: int, end: int) -> None:
        out[kind].append((start, end))
        over[kind] = end

    for last, (kind, size) in automaton.iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= over["dotted"]:
                over["dotted"] = end = DOTTED.match(text, at).end()
                out["ip"].extend(_quads(text[at:end], at))
            if at >= over["spaced"]:
                over["spaced"] = end = SPACED.match(text, at).end()
                digits = text[at:end].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    out["card"].append((at, end))
        elif kind == "at":
            start = _left(text, at, LOCAL, over["email"])
            if start < at and (host := DOMAIN.match(text, at + 1)):
                keep("email", start, host.end())
        elif kind == "plus":
            if at >= over["phone"] and (number := DIALLED.match(text, at)):
                over["phone"] = number.end()
                if 9 <= sum(c.isdigit() for c in number[0]) <= 15:
                    out["phone"].append(number.span())
        elif kind == "scheme":
            start = _left(text, at, SCHEME, over["url"])
            while start < at and not (text[start].isascii() and text[start].isalpha()):
                start += 1
            if start < at and (found := ADDRESS.match(text, at)):
                end = at + len(found[0].rstrip(".,;:!?)"))
                over["url"] = found.end()
                if "." in text[at:end] or "]" in text[at:end]:
                    out["url"].append((start, end))
        elif kind == "written":
            stop = at - 1 if text[at - 1:at] == " " else at
            start = _left(text, stop, LOCAL, over["written_email"])
            if start < stop and (host := WRITTEN_HOST.match(text, last + 1)):
                keep("written_email", start, host.end())
        elif not (at and (text[at - 1].isalnum() or text[at - 1] == "_")):
            if kind == "iban":
                found = AFTER_IBAN.match(text, last + 1)
                if found and found.start(1) >= over["iban"] and (span := _iban(text, *found.span(1))):
                    keep("iban", *span)
            elif last + 1 >= over["account"] and (found := AFTER_CUE.match(text, last + 1)) and found.start(1) > last + 1:
                name, over["account"] = found[1], found.end()
                if sum(map(str.isalnum, name)) >= 6 and sum(map(str.isdigit, name)) >= 2:
                    out["account"].append(found.span(1))
    return out


def _found(batches):
    automaton = anchors()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in pieces(batches, "text"):
        rows = [
            [{"kind": k, "start": a, "end": b} for k, found in spans_of(t, automaton).items() for a, b in found] if t else []
            for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(kind))], ["key", "text", "spans"])


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, spans): ``spans`` is an array of (kind, start, end), kinds in the order of KINDS, then by start.

    One row per row of ``docs``, repeated ids and texts included; other columns are dropped, whatever their names. A null
    text counts as empty and has no spans. Texts are scanned whole, one at a time. Kinds may overlap one another.
    Cues that mix upper and lower case in another way than title case are not anchors. One scan, no shuffle.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(_found, f"key {dict(rows.dtypes)['key']}, text string, spans array<struct<kind string, start long, end long>>")
    return found.withColumnsRenamed({"key": key, "text": text})


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) with every span replaced by its kind in angle brackets; of overlapping spans the first, then longest, counts."""
    order = F.array_sort(F.col("spans"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(
        a["end"] != b["end"], b["end"] - a["end"]).when(a["kind"] < b["kind"], -1).otherwise(1).cast("int"))
    body = F.col(text)
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        joined = F.concat(state["done"], F.substring(body, state["at"].cast("int") + 1, (span["start"] - state["at"]).cast("int")),
                          F.lit("<"), span["kind"], F.lit(">"))
        take = span["start"] >= state["at"]
        return F.struct(F.when(take, joined).otherwise(state["done"]).alias("done"), F.when(take, span["end"]).otherwise(state["at"]).alias("at"))

    clean = F.aggregate(order, start, step, lambda s: F.concat(s["done"], F.substring(body, s["at"].cast("int") + 1, F.length(body))))
    return find(docs, key, text).select(key, clean.alias(text))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans, of every document."""
    found = find(table(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
