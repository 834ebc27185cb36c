"""Benchmark decontamination by a prefix-filtered join; DataFrame functions only.

A benchmark item is cut into windows of WINDOW consecutive words. A document contains a window only if it contains every
word pair of it, so it is enough to look for the pair that is rarest in the documents (the prefix of a containment join
with threshold 1). Where a document has such a pair, the window's start follows from the pair's place in it; what
lies inside the document's bounds is compared as a whole window, word for word.

While the benchmark has at most LITERALS distinct pairs, they are part of the scan's expression: each text is read twice
(to count the pairs, to find the prefixes) and leaves one light row with the words around its hits. Beyond that,
rows of (document, place, pair) are joined with the pairs, and the hits are joined back to the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import lower_az, stored, table, without

WINDOW = 10
#: Distinct word pairs of a benchmark that still go into an expression (8 bytes each).
LITERALS = 20_000
#: Fixed value: every character that is no word character (ASCII without digits and letters).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the words of a text in order; a gap at either end leaves an empty string there, which is cut off."""
    cut = df.withColumn("_cut", F.split(F.coalesce(text, F.lit("")), GAP))
    lead = (F.get("_cut", F.lit(0)) == "").cast("int")
    tail = ((F.size("_cut") > 1) & (F.try_element_at("_cut", F.lit(-1)) == "")).cast("int")
    return cut.withColumn(name, F.slice("_cut", lead + 1, F.size("_cut") - lead - tail)).drop("_cut")


def _pairs(words: Column) -> Column:
    """Hash of each word with the next one; case is folded more coarsely here, exactly in the comparison of windows."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))


def windows_of(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, words, length): each item's distinct windows; an item of fewer words is one window."""
    items = with_words(benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text")),
                       lower_az(F.col("text")), "w")
    n = F.size("w")
    return items.where(n > 0).select(
        "item", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))),
                                      lambda i: F.slice("w", i, window))).alias("words")
    ).distinct().withColumn("length", F.size("words"))


def _prefixes(spots: DataFrame, seen: DataFrame) -> DataFrame:
    """The rarest pair of each window; a window with a pair that no document has needs no search."""
    rarest = spots.join(seen, "pair", "left").groupBy("win", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pair", "offset")).alias("first"))
    return stored(rarest.where("first.n > 0").select("win", "length", "first.pair", "first.offset"))


def _by_literals(folded: DataFrame, known: DataFrame, spots: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(doc, print, n_words) of each document, and its tries (doc, print, start, length, win, words)."""
    def member(x: str, pairs: list[int]) -> str:
        return f"{x} IN ({', '.join(f'{p}L' if p > -2**63 else 'bigint(-9223372036854775808)' for p in pairs)})" if pairs else "false"

    # a window of one word has a single "pair", that of the word with no next one; it may stand anywhere
    def places(pairs: list[int], lone: list[int]) -> Column:
        hit = F.expr(f"transform(h, (x, i) -> CASE WHEN {member('x', pairs)} THEN named_struct('at', i, 'pair', x) END)")
        if lone:
            one = "xxhash64(x, CAST(NULL AS STRING))"
            hit = F.concat(hit, F.expr(f"transform(f, (x, i) -> CASE WHEN {member(one, lone)} THEN named_struct('at', i, 'pair', {one}) END)"))
        return F.filter(hit, lambda x: x.isNotNull())

    def split(df: DataFrame) -> tuple[list[int], list[int]]:
        got = df.select("pair", "length").distinct().collect()
        return sorted(r["pair"] for r in got if r["length"] > 1), sorted(r["pair"] for r in got if r["length"] == 1)

    seen = folded.select(F.explode(places(*split(known))).alias("x")).groupBy("x.pair").agg(F.count("*").alias("n"))
    prefix = _prefixes(spots, seen)
    hits = folded.withColumn("hits", places(*split(prefix)))
    reach = F.lit(window - 2)
    scanned = stored(hits.select("doc", "print", F.size("w").cast("long").alias("n_words"), F.transform("hits", lambda x: F.struct(
        x["at"].alias("at"), x["pair"].alias("pair"),
        F.slice("w", F.greatest(x["at"] - reach, F.lit(0)) + 1, 2 * window - 2).alias("around"))).alias("hits")))
    at = scanned.select("doc", "print", F.explode("hits").alias("x")).select("doc", "print", "x.*")
    tries = at.join(prefix, "pair").where("at >= offset").withColumn("first", F.col("at") - F.col("offset"))
    tries = tries.withColumn("words", F.transform(
        # Spark may compute this before the filter above, so the start is kept valid
        F.slice("around", F.greatest(F.col("first") - F.greatest(F.col("at") - reach, F.lit(0)) + 1, F.lit(1)), F.col("length")), lower_az))
    return scanned, tries.where(F.size("words") == F.col("length")).select(
        "doc", "print", (F.col("first") + 1).alias("start"), "length", "win", "words").distinct()


def _by_join(rows: DataFrame, folded: DataFrame, known: DataFrame, spots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As above for a benchmark of any size."""
    scanned = stored(folded.select("doc", "print", F.size("w").cast("long").alias("n_words")))
    places = folded.select("doc", "print", F.posexplode("h").alias("at", "pair"))
    if known.where("length = 1").limit(1).count():
        places = places.unionByName(folded.select("doc", "print", F.posexplode(
            F.transform("f", lambda w: F.xxhash64(w, F.lit(None).cast("string")))).alias("at", "pair"))).distinct()
    seen = places.join(known, "pair", "left_semi").groupBy("pair").agg(F.count("*").alias("n"))
    prefix = _prefixes(spots, seen)
    hits = places.join(prefix.select("pair").distinct(), "pair", "left_semi")
    tries = hits.join(prefix, "pair").where("at >= offset").select(
        F.col("doc").alias("_doc"), F.col("print").alias("_print"), (F.col("at") - F.col("offset") + 1).alias("start"), "length", "win")
    tries = stored(tries.groupBy("_doc", "_print").agg(F.collect_set(F.struct("start", "length", "win")).alias("tries")))
    both = rows.dropDuplicates(["doc", "print"]).join(
        tries, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("print") == F.col("_print")))
    both = with_words(both, lower_az(F.col("text")), "w")
    out = both.select("doc", "print", F.explode(F.transform(
        F.filter("tries", lambda t: t["start"] + t["length"] - 1 <= F.size("w")),
        lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"), t["win"].alias("win"),
                           F.slice("w", t["start"], t["length"]).alias("words")))).alias("x"))
    return scanned, out.select("doc", "print", "x.*")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """(key, n_words, n_hit, items, contaminated) for every row of ``docs``.

    Words are runs of ASCII digits and letters (A-Z lower-cased) and of all characters beyond ASCII. ``n_hit`` counts the
    words inside any occurrence of a window, ``items`` lists the items whose windows occur, as sorted strings.
    A null or empty text has no words and no hits; items without words have no windows; repeated items and
    windows count once. Null keys and repeated keys are kept as rows of their own. Empty tables give no rows
    or no hits.
    """
    return _judged(docs, benchmark, key, text, item, item_text, window, literals).drop("_print")


def _judged(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int,
            literals: int) -> DataFrame:
    """As ``contamination``, with the hash of each row's text (_print)."""
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    wins = windows_of(benchmark, item, item_text, window).withColumn("w", F.transform("words", lambda w: F.lower(w)))
    wins = stored(wins.select("item", "words", "length", F.xxhash64("words").alias("win"), _pairs(F.col("w")).alias("pairs")))

    spots = wins.select("win", "length", F.posexplode("pairs").alias("offset", "pair")).where(
        "offset < length - 1 OR length = 1").distinct()
    known = stored(spots.groupBy("pair").agg(F.min("length").alias("length")))
    folded = with_words(rows, F.col("text"), "w")
    folded = folded.withColumn("f", F.transform("w", lambda w: F.lower(w))).withColumn("h", _pairs(F.col("f")))
    if known.count() <= literals:
        scanned, found = _by_literals(folded, known, spots, window)
    else:
        scanned, found = _by_join(rows, folded, known, spots)
    sure = stored(found.where(F.xxhash64("words") == F.col("win")).join(
        wins.select("words", "item"), "words").select("doc", "print", "start", "length", "item"))

    hit = sure.select("doc", "print", "start", "length").distinct().select("doc", "print", F.explode(
        F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct().groupBy("doc", "print").agg(
        F.count("*").alias("n_hit"))
    items = sure.groupBy("doc", "print").agg(F.array_sort(F.collect_set("item")).alias("items"))
    facts = hit.join(items, hit["doc"].eqNullSafe(items["doc"]) & (hit["print"] == items["print"])).select(
        hit["doc"].alias("_doc"), hit["print"].alias("_print"), "n_hit", "items")
    counted = scanned.join(facts, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("print") == F.col("_print")), "left")
    none = F.array().cast("array<string>")
    return counted.select(
        F.col("doc").alias(key), F.col("print").alias("_print"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text contains a benchmark window go."""
    judged = _judged(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text", WINDOW, LITERALS)
    return without(docs, judged.where("contaminated"))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item, w[i:i + 9] AS win, len(w[i:i + 9]) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT s.doc_id, s.i, s.n, wins.item FROM spots s JOIN wins ON s.n = wins.n AND s.win = wins.win),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
