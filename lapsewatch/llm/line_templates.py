"""Line dedup by a log-template tree.

Each line walks a tree of fixed depth: its token count and its first LEAD tokens, tokens with digits counting as a variable
field. Inside a leaf, lines join the first template that agrees with them in SIMILAR of the places, and
places that differ become variable. A template that occurs in MIN_DOCS documents or more recurs, and its lines are dropped;
lines of fewer than SHORT tokens, which may be alike by chance, recur from SHORT_DOCS documents.

Lines first shrink to distinct lines by leaf, counted with map-side sums; only leaves that hold several distinct lines
fetch their tokens. A leaf with more than PART lines is parsed in parts, whose templates are parsed together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import stored, table
from .texts import GOLDEN, MIX_1, Words, mix, pieces, texts_of, words_of

LEAD, SIMILAR = 3, 0.7
#: A template recurs from so many documents; shorter lines (in tokens) are left alone.
MIN_DOCS, MIN_TOKENS = 2, 4
#: Lines of fewer tokens than this recur from so many documents.
SHORT, SHORT_DOCS = 8, 3
PART = 2000
#: Tokens with a digit, and places of a template where its lines differ; hashes of other tokens are odd.
WILD, VARIES = 0, 2
DIGIT = np.zeros(256, np.int64)
DIGIT[ord("0"):ord("9") + 1] = 1


def _lines(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All lines of a batch of texts, with the row and the line number of each."""
    split = [t.split(b"\n") for t in texts_of(batch, "text")]
    n = np.fromiter(map(len, split), np.int64, len(split))
    row = np.repeat(np.arange(len(n)), n)
    return [line for lines in split for line in lines], row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def masked(words: Words) -> np.ndarray:
    """Token hashes, WILD for tokens with a digit."""
    digits = np.concatenate(([0], np.cumsum(DIGIT[words.data])))
    return np.where(digits[words.end] > digits[words.start], np.uint64(WILD), words.hash | np.uint64(1))


def keys_of(words: Words, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, line) hashes of each text that has words; texts are lines here."""
    n = np.diff(words.bounds)
    some = np.flatnonzero(n)
    begin = words.bounds[:-1][some]
    place = (np.arange(len(tokens)) - words.bounds[:-1][words.text]).astype(np.uint64)
    line = mix(np.add.reduceat(mix(tokens + place * GOLDEN), begin)) if len(some) else np.zeros(0, np.uint64)
    leaf = n[some].astype(np.uint64) * GOLDEN
    for k in range(LEAD):
        leaf = mix(leaf ^ np.where(n[some] > k, tokens[np.minimum(begin + k, len(tokens) - 1)], np.uint64(3))) * MIX_1
    return leaf, line


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        lines, row, number = _lines(batch)
        words = words_of(lines)
        leaf, line = keys_of(words, masked(words))
        some = np.flatnonzero(np.diff(words.bounds))
        ids = batch.column(batch.schema.get_field_index("doc")).take(pa.array(row[some]))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(number[some].astype(np.int32)), pa.array(np.diff(words.bounds)[some].astype(np.int32)),
             pa.array(leaf.view(np.int64)), pa.array(line.view(np.int64))], ["doc", "number", "tokens", "leaf", "line"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of the wanted lines of each text."""
    for batch in pieces(batches, "text"):
        wanted = batch.column(batch.schema.get_field_index("wanted")).to_pylist()
        lines = [t.split(b"\n")[i] for t, w in zip(texts_of(batch, "text"), wanted) for i in w]
        words = words_of(lines)
        tokens = masked(words)
        leaf, line = keys_of(words, tokens)
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf.view(np.int64)), pa.array(line.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(words.bounds.astype(np.int32)), pa.array(tokens.view(np.int64)))], ["leaf", "line", "tokens"])


def group_lines(lines: np.ndarray, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Template number of each row of equally long token rows, taken in order, and the templates.

    A row joins the template with the most equal places if they are ``similar`` of all places; places that differ become
    variable (VARIES) and count as equal to nothing from then on. So at least that share of a template stays fixed, and all its
    rows agree there.
    """
    templates = np.empty_like(lines)
    number = np.empty(len(lines), np.int64)
    n = 0
    for i, tokens in enumerate(lines):
        agree = ((templates[:n] == tokens) & (tokens != VARIES)).sum(1)
        at = int(agree.argmax()) if n else 0
        if n and agree[at] >= similar * len(tokens):
            templates[at] = np.where(templates[at] == tokens, tokens, VARIES)
        else:
            at, n = n, n + 1
            templates[at] = tokens
        number[i] = at
    return number, templates[:n]


def _group(similar: float):
    def group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("docs", "descending"), ("line", "ascending")]).combine_chunks()
        flat = rows["tokens"].combine_chunks().flatten().to_numpy()
        lines = flat.reshape(rows.num_rows, -1)
        number, templates = group_lines(lines, similar)
        line = rows["line"].to_numpy()
        first = line[np.unique(number, return_index=True)[1]]
        return pa.table({"leaf": rows["leaf"], "line": rows["line"], "docs": rows["docs"], "template": pa.array(first[number]),
                         "tokens": pa.array(list(templates[number]), pa.list_(pa.int64()))})

    return group


def templates(docs: DataFrame, similar: float = SIMILAR, part: int = PART, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, number, tokens, template): the template of every line that has tokens; ``docs`` is (doc, text).

    Leaves of fewer lines than ``min_docs`` are not parsed: no template of theirs can occur in so many documents.
    """
    rows = stored(docs.mapInArrow(_parse, f"doc {dict(docs.dtypes)['doc']}, number int, tokens int, leaf long, line long"))
    distinct = stored(rows.groupBy("leaf", "line").agg(
        F.count("*").alias("docs"), F.min(F.struct("doc", "number")).alias("at")))
    mixed = distinct.groupBy("leaf").agg(F.count("*").alias("lines"), F.sum("docs").alias("n")).where(
        (F.col("lines") > 1) & (F.col("n") >= min_docs))
    several = stored(distinct.join(mixed.select("leaf", "lines"), "leaf"))
    wanted = several.select("at.doc", "at.number").groupBy("doc").agg(F.sort_array(F.collect_set("number")).alias("wanted"))
    wanted = wanted.withColumnRenamed("doc", "_doc").hint("shuffle_hash")
    texts = docs.join(wanted, docs["doc"].eqNullSafe(wanted["_doc"])).select("text", "wanted")
    tokens = texts.mapInArrow(_fetch, "leaf long, line long, tokens array<long>").dropDuplicates(["leaf", "line"])
    ready = several.drop("at").join(tokens, ["leaf", "line"])
    kind = "leaf long, line long, docs long, template long, tokens array<long>"
    parts = F.ceil(F.col("lines") / part)
    once = stored(ready.groupBy("leaf", F.pmod(F.xxhash64("line"), parts).alias("part")).applyInArrow(_group(similar), kind))
    heads = once.where("line = template").select("leaf", "line", "docs", "tokens")
    again = heads.groupBy("leaf").applyInArrow(_group(similar), kind).select("leaf", F.col("line").alias("template"), F.col("template").alias("final"))
    final = once.join(again, ["leaf", "template"]).select("leaf", "line", "final")
    named = distinct.join(final, ["leaf", "line"], "left").select("leaf", "line", F.coalesce("final", "line").alias("template"))
    return rows.join(named, ["leaf", "line"]).select("doc", "number", "tokens", F.xxhash64("leaf", "template").alias("template"))


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                   min_tokens: int = MIN_TOKENS, short: int = SHORT, short_docs: int = SHORT_DOCS) -> DataFrame:
    """(key, n_lines, n_dropped, text) for every row of ``docs``: the text without the lines of recurring templates.

    Lines end at line feeds, tokens are runs of anything but space and control characters 9 to 13, A-Z lower-cased. Lines
    of fewer than ``min_tokens`` tokens stay. A template recurs from ``min_docs`` documents, one of fewer than ``short`` tokens
    from ``short_docs`` if that is more. A null text has no lines and stays null; an empty one has one
    empty line. Rows with equal keys are one document: they lose each other's dropped lines where their texts are equal.
    All rows without a key count as one document together. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("doc", F.struct(F.col("_id").alias("id"), F.xxhash64("text").alias("print")))
    lined = templates(rows.select("doc", "text"), min_docs=min_docs)
    # stored, as is what goes: the shuffles behind a stored table are deleted before the next ones are written
    long = stored(lined.where(F.col("tokens") >= min_tokens))
    # all lines of a template have as many tokens
    recurring = long.select("template", "tokens", F.col("doc.id").alias("id")).distinct().groupBy("template", "tokens").agg(
        F.count("*").alias("docs")).where(
        F.col("docs") >= F.when(F.col("tokens") < short, max(min_docs, short_docs)).otherwise(min_docs))
    gone = long.join(recurring, "template", "left_semi").groupBy("doc").agg(F.collect_set("number").alias("gone"))
    gone = stored(gone).withColumnRenamed("doc", "_doc").hint("shuffle_hash")
    both = rows.join(gone, rows["doc"].eqNullSafe(gone["_doc"]), "left")
    both = both.withColumn("lines", F.split("text", "\n"))
    kept = F.array_join(F.filter("lines", lambda line, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False))), "\n")
    return both.select(F.col("_id").alias(key), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    out = drop_recurring(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
