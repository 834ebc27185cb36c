import random
import re

import pytest

from lapsewatch.llm.decontaminate import contamination

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for s in {tuple(v[i:i + window]) for i in range(max(1, len(v) - window + 1))} if v else ():
            for i in range(len(w) - len(s) + 1):
                if tuple(w[i:i + len(s)]) == s:
                    hit |= set(range(i, i + len(s)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit)


@pytest.mark.parametrize("literals", [20_000, 0])
def test_matches_every_window(spark, literals):
    rng = random.Random(1)
    few = ["the", "of", "and", "Über", "über", "x", "y2"]
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([1, 2, 5, 10, 11, 14])))) for i in range(12)]
    items += [(50, None), (51, "..."), (3, items[4][1]), (60, "lone"), (61, "same words same words same words same words same words same words")]
    docs = [(i, ", ".join(rng.choice(few) for _ in range(rng.choice([0, 1, 9, 10, 60])))) for i in range(25)]
    docs += [(100, "start " + items[7][1]), (101, items[7][1].upper() + "!"), (102, None), (103, ""), (104, "-- lone --"),
             (105, "(same words) " * 9), (105, "another text of one id"), (106, "word " * 3000 + items[6][1])]
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, pair string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(df, bench, literals=literals).collect()
    assert sorted((r[0], *r[1:3], list(r[3]), r[4]) for r in got) == sorted((i, *brute(t, items, 10)) for i, t in docs)


def test_empty_tables_and_null_keys(spark):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "a b c")], "item_id string, text string")
    assert [r["contaminated"] for r in contamination(docs, bench).collect()] == [True, True]
    assert [r["contaminated"] for r in contamination(docs, bench.limit(0)).collect()] == [False, False]
    assert contamination(docs.limit(0), bench).count() == 0
