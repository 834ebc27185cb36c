import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lapsewatch.llm.ppm import scores

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = ["The cat sat on the mat", "the cat  sat on a hat", "A dog sat\ton THE log", "cats and dogs", "", None, "   ", "the the the",
         "é È the émat", "x" * 100 + " y", "the cat sat on the mat", "zebra quagga", "on the mat the cat sat", "dog", "a a a b"]


def tokens(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 0


class Trie:
    """Symbol by symbol, with explicit contexts, escapes by method D and exclusion."""

    def __init__(self, order):
        self.order, self.counts = order, defaultdict(Counter)

    def symbols(self, text):
        data = b"\n" * self.order + b"".join(w + b" " for w in tokens(text)) + b"\n"
        return [(data[i - self.order:i], data[i]) for i in range(self.order, len(data))]

    def learn(self, text):
        for context, symbol in self.symbols(text):
            for k in range(self.order + 1):
                self.counts[context[self.order - k:]][symbol] += 1

    def p(self, context, symbol):
        p, out = 1.0, set()
        for k in range(self.order, -1, -1):
            seen = {s: n for s, n in self.counts.get(context[self.order - k:], {}).items() if s not in out}
            if not seen:
                continue
            total = sum(seen.values())
            if symbol in seen:
                return p * (seen[symbol] - 0.5) / total
            p *= 0.5 * len(seen) / total
            out |= set(seen)
        return p / (252 - len(out))


@pytest.mark.parametrize("order", [1, 3])
def test_scores_match_a_plain_trie(spark, order):
    rows = list(enumerate(TEXTS)) + [(3, "cats and dogs"), (None, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trie, words = Trie(order), Counter()
    for i, t in rows:
        if not held(i):
            trie.learn(t)
            words.update([*tokens(t), None])
    n, v = sum(words.values()), len(words)
    want = sorted(
        (str(i), held(i), len(tokens(t)) + 1, sum(words[w] > 0 for w in [*tokens(t), None]), n,
         round(sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*tokens(t), None]), 9),
         round(sum(math.log10(trie.p(c, s)) for c, s in trie.symbols(t)), 9)) for i, t in rows)
    for block in (32_000_000, 60):
        got = scores(docs, folds=3, order=order, block=block).collect()
        assert sorted((str(r[0]), *r[1:5], round(r[5], 9), round(r[6], 9)) for r in got) == want


def test_probabilities_sum_to_one():
    trie = Trie(2)
    for t in TEXTS[:9]:
        trie.learn(t)
    symbols = [*(b for b in range(256) if b not in (9, 11, 12, 13)), ]
    for context in (b"th", b"\n\n", b"qq", b"e "):
        assert abs(sum(trie.p(context, s) for s in symbols) - 1) < 1e-12


def test_without_training_rows_and_empty(spark):
    docs = spark.createDataFrame([(i, "ab") for i in range(40) if held(i)], "doc_id long, text string")
    for r in scores(docs, folds=3).collect():
        assert r["n_known"] == 0 and r["train_tokens"] == 0
        assert r["base_score"] == 0 and abs(r["score"] - 4 * math.log10(1 / 252)) < 1e-9
    assert scores(docs.limit(0)).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "k"), (2, "a", 6, "g")], "doc_id long, text string, n long, key string")
    assert scores(docs).columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_input_splits_as_blocks(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    by_split = sorted((r[0], r[1], r[2], r[3], round(r[5], 9), round(r[6], 9)) for r in scores(docs, folds=3, splits=True).collect())
    assert by_split == sorted((r[0], r[1], r[2], r[3], round(r[5], 9), round(r[6], 9)) for r in scores(docs, folds=3).collect())
