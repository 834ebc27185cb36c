"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

Voters are a fixed lexicon and patterns (whole words and word beginnings) that are significantly more frequent in documents
labelled toxic. A voter that does not fire abstains. The label model estimates each voter's accuracy by expectation
maximisation over the votes of all documents that may be learned from, started and anchored by the labelled sample, and
discounts voters by their correlations, measured as the votes that come with theirs beyond what independent voters would
bring. A logistic regression is then fitted to the posteriors. Texts are read twice (patterns, votes), whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import held_out, stored, table, without
from .texts import GOLDEN, Words, mix, pieces, texts_of, words_of

#: Insults that mark a text as toxic in English.
LEXICON = (
    "asshole", "bastard", "bitch", "clown", "cretin", "cunt", "dickhead", "disgusting", "dumbass", "filth", "freak", "fucker",
    "garbage", "idiot", "idiotic", "imbecile", "jackass", "loser", "lowlife", "maggot", "moron", "moronic", "parasite",
    "pathetic", "pig", "psycho", "retard", "scum", "scumbag", "shithead", "slut", "stupid", "subhuman", "trash", "vermin",
    "whore", "wimp", "worthless")
#: Word beginnings, in bytes.
PREFIXES = (3, 4, 5, 6, 7)
#: Bounds: labelled rows that patterns are learned from, voters.
LABELLED, VOTERS = 12_000, 400
#: A pattern must be toxic this often, and be expected by chance fewer times than this among all patterns of its length.
PRECISION, CHANCE = 0.9, 0.5
#: Labelled toxic and clean rows that a lexicon voter is credited with before any are seen.
CREDIT = (3.0, 0.5)
STEPS = 5
GAP = np.ones(256, bool)
GAP[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False


def patterns(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, text numbers, 64-bit pattern hashes) of the whole words (length 0) and of each length of beginning."""
    yield 0, words.text, words.hash
    eight = np.ndarray(len(words.data) - 7, "<u8", words.data.tobytes(), strides=(1,))[words.start]
    size = words.end - words.start
    for k in PREFIXES:
        longer = np.flatnonzero(size > k)
        yield k, words.text[longer], mix((eight[longer] & np.uint64((1 << (8 * k)) - 1)) ^ np.uint64(int(GOLDEN) * k % 2**64))


def lexicon_patterns() -> list[int]:
    return words_of([w.encode() for w in LEXICON], GAP).hash.view(np.int64).tolist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in which each pattern occurs, by label, added up for each piece."""
    for batch in pieces(batches, "text"):
        toxic = batch.column(batch.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False).astype(bool)
        for length, text, h in patterns(words_of(texts_of(batch, "text"), GAP)):
            order = np.lexsort((text, h))
            text, h = text[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            text, h = text[new], h[new]
            if not len(h):
                continue
            at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            t = np.add.reduceat(toxic[text].astype(np.int64), at)
            n = np.diff(np.append(at, len(h)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[at].view(np.int64)), pa.array(np.full(len(at), length, np.int32)), pa.array(t), pa.array(n - t)],
                ["pattern", "length", "t", "c"])


def _vote(voters: list[int]):
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(voters, np.int64).view(np.uint64)
        order = np.argsort(known)
        ranked = known[order]
        maybe = np.zeros(1 << 16, bool)
        maybe[known & np.uint64(0xFFFF)] = True
        for batch in pieces(batches, "text"):
            texts, fired = [], []
            for _, text, h in patterns(words_of(texts_of(batch, "text"), GAP)):
                near = np.flatnonzero(maybe[h & np.uint64(0xFFFF)])
                at = np.minimum(np.searchsorted(ranked, h[near]), len(ranked) - 1)
                hit = ranked[at] == h[near]
                texts.append(text[near[hit]])
                fired.append(order[at[hit]])
            pairs = np.unique(np.concatenate(texts) * len(known) + np.concatenate(fired))
            bounds = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * len(known)).astype(np.int32)
            votes = pa.ListArray.from_arrays(pa.array(bounds), pa.array((pairs % len(known)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("id", "print")), votes],
                                             ["id", "print", "votes"])

    return vote


def _significant(n_patterns: Column, base: float) -> Column:
    """Whether t toxic among t + c documents is beyond chance (Chernoff bound, corrected for the patterns tried)."""
    n = F.col("t") + F.col("c")
    p = F.col("t") / n
    clean = F.when(F.col("c") > 0, F.col("c") * F.log((1 - p) / (1 - base))).otherwise(0.0)
    return (p >= PRECISION) & (F.col("t") * F.log(p / base) + clean >= F.log(n_patterns / CHANCE))


def choose_voters(docs: DataFrame, labels: DataFrame) -> list[tuple[int, float, float]]:
    """(pattern, labelled toxic documents, labelled clean ones) of at most VOTERS voters, the lexicon first.

    ``labels`` (id, toxic 0/1) are drawn in hash order, LABELLED rows at most.
    """
    sample = stored(labels.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(LABELLED))
    n, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    lexicon = {h: [CREDIT[0], CREDIT[1]] for h in lexicon_patterns()}
    base = (toxic or 0) / n if n else 0.0
    if not 0 < base < 1:
        return [(h, *tc) for h, tc in lexicon.items()]
    counts = docs.join(sample, "id").select("text", "toxic").mapInArrow(_count, "pattern long, length int, t long, c long")
    counts = stored(counts.groupBy("pattern", "length").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t > 0"))
    tried = F.lit(1)
    for r in counts.groupBy("length").count().collect():
        tried = F.when(F.col("length") == r["length"], r["count"]).otherwise(tried)
    known = F.col("pattern").isin(list(lexicon))
    best = counts.where(known | _significant(tried, base)).orderBy(~known, F.desc("t"), "c", "pattern").limit(VOTERS).collect()
    found = lexicon | {r["pattern"]: [r["t"] + (CREDIT[0] if r["pattern"] in lexicon else 0.0), r["c"] + CREDIT[1]] for r in best}
    return [(h, *tc) for h, tc in found.items()]


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _sum_of(values: list[float]) -> Column:
    """Sum of the votes' values."""
    table_ = F.array(*[F.lit(float(v)) for v in values])
    return F.aggregate(F.transform("votes", lambda j: F.get(table_, j)), F.lit(0.0), lambda a, x: a + x)


def label_model(seen: DataFrame, voters: list[tuple[int, float, float]], base: float) -> Column:
    """Log odds of being toxic by the votes, fitted to ``seen`` (votes, n): distinct votes and how many documents cast them."""
    labelled = [(t, c) for _, t, c in voters]
    accuracy, discount = [t / (t + c) for t, c in labelled], [1.0] * len(voters)
    prior = _logit(base)
    spread = seen.select("n", F.size("votes").alias("with"), "votes", F.explode("votes").alias("j"))
    odds = F.lit(prior)
    for _ in range(STEPS):
        odds = F.lit(prior) + _sum_of([d * (_logit(a) - prior) for a, d in zip(accuracy, discount)])
        post = 1 / (1 + F.exp(-odds))
        rows = spread.groupBy("j").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * post).alias("toxic"), F.sum(F.col("n") * post * (F.col("with") - 1)).alias("others")).collect()
        any_toxic = max(1e-9, seen.agg(F.sum(F.when(F.size("votes") > 0, F.col("n") * post))).first()[0] or 0.0)
        expected = sum(r["toxic"] for r in rows) / any_toxic
        for r in rows:
            t, c = labelled[r["j"]]
            accuracy[r["j"]] = (r["toxic"] + t) / (r["n"] + t + c)
            alone = max(0.0, expected - r["toxic"] / any_toxic)
            discount[r["j"]] = 1 / (1 + max(0.0, r["others"] / max(r["toxic"], 1e-9) - alone))
    return odds


def classifier(seen: DataFrame, odds: Column, n_voters: int) -> tuple[float, list[float], float]:
    """(intercept, weight of each voter, weight of the label model's verdict) of a logistic regression on the posteriors.

    Fitted on all distinct votes; each counts as toxic and as clean by its posterior, as often as it was cast.
    """
    named = seen.withColumn("p", 1 / (1 + F.exp(-odds))).select("n", "p", F.concat(
        F.transform("votes", lambda j: j.cast("string")),
        F.when(F.col("p") > 0.5, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>"))).alias("words"))
    vectors = CountVectorizerModel.from_vocabulary(
        [*map(str, range(n_voters)), "toxic"], inputCol="words", outputCol="features")
    both = vectors.transform(named).select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("x")).select("features", "x.*")
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50).fit(stored(both))
    weights = model.coefficients.toArray().tolist()
    return model.intercept, weights[:-1], weights[-1]


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id",
          toxic: str = "toxic", folds: int = 5) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``.

    Rows whose CRC-32 of the id as text is divisible by ``folds`` are held out: neither their labels nor their votes are
    learned from. Null and empty texts cast no votes and get the lowest score. Null keys match no label; of several labels
    of one key the largest counts; null labels are ignored. Without labels the lexicon votes alone. An empty table gives
    no rows.
    """
    return _judged(docs, labels, key, text, label_key, toxic, folds).drop("_print")


def _judged(docs: DataFrame, labels: DataFrame, key: str, text: str, label_key: str, toxic: str, folds: int) -> DataFrame:
    """As ``score``, with the hash of each row's text (_print)."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    learn = labels.select(F.col(label_key).alias("id"), F.col(toxic).cast("int").alias("toxic")).where(
        F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("id", folds))
    voters = choose_voters(rows, learn)
    base = learn.agg(F.avg("toxic")).first()[0] or 0.05
    kind = dict(rows.dtypes)["id"]
    printed = rows.withColumn("print", F.xxhash64(F.coalesce("text", F.lit(""))))
    voted = stored(printed.mapInArrow(_vote([h for h, _, _ in voters]), f"id {kind}, print long, votes array<int>"))
    seen = stored(voted.where(~held_out("id", folds)).groupBy("votes").agg(F.count("*").alias("n")))
    odds = label_model(seen, voters, base)
    if seen.where(odds > 0).limit(1).count() and seen.where(odds <= 0).limit(1).count():
        intercept, weights, verdict = classifier(seen, odds, len(voters))
        odds = F.lit(intercept) + _sum_of(weights) + F.when(odds > 0, verdict).otherwise(0.0)
    out = voted.select(F.col("id").alias(key), F.col("print").alias("_print"), held_out("id", folds).alias("held_out"), (1 / (1 + F.exp(-odds))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is predicted toxic go."""
    judged = _judged(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "doc_id", "toxic", 5)
    return without(docs, judged.where("predicted = 1"))
