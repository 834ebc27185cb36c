import random
import re
from itertools import combinations

from lapsewatch.llm.components import components
from lapsewatch.llm.near_dup import near_duplicates, stage
from lapsewatch.llm.tables import stored


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute(rows, width, percent=80):
    """Component of each id by comparing every pair of texts."""
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = sorted((find(a), find(b)))
            least[y] = x
    return {i: find(i) for i in least}


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    passage = " ".join(rng.choice(vocabulary) for _ in range(25))
    for group in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 40, 120, 300]))]
        for copy in range(rng.choice([1, 2, 3, 12])):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
            rows.append((n, text + (" " + passage if group % 3 == 0 else "")))
            n += 1
    # one large group whose members are near a base, not always near each other
    base = [rng.choice(vocabulary) for _ in range(150)]
    for copy in range(70):
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(words)))
        n += 1
    rows += [(n, rows[-1][1]), (n + 1, rows[-1][1].upper()), (n + 2, None), (n + 3, ""), (n + 4, "  \n"), (n + 5, "One two"),
             (n + 6, "one\ttwo"), (n + 7, "long " * 5000), (n + 7, "long " * 5000)]
    return rows


def test_components_match_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, rep int").repartition(5)
    for width in (4, 5):
        want = brute(rows, width)
        got = near_duplicates(docs, width=width).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    sizes = {i: len(shingles(t, 5)) for i, t in rows}
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes


def test_null_and_repeated_keys(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (5, text), (3, text), (3, "quite another text than those"), (9, "quite another text than those"),
                                  (None, "alone here with nobody else"), (None, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_duplicates(docs).collect())
    assert got == sorted([("None", "3", False), ("5", "3", False), ("3", "3", True), ("3", "3", True), ("9", "3", False),
                          ("None", "None", True), ("None", "None", True)])
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, None)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}}


def test_copies_without_keys_and_keys_of_several_texts(spark):
    words = [f"w{i}" for i in range(60)]
    base, near = " ".join(words), " ".join([*words[:-1], "other"])
    odd, close = " ".join(f"o{i}" for i in range(60)), " ".join([*(f"o{i}" for i in range(59)), "end"])
    a, b, c = (" ".join(f"{x}{i}" for i in range(9)) for x in "abc")
    rows = [(None, base), (None, base), (None, near), (None, odd), (2**63 - 5, close), (None, "alone in the world of texts"), (None, None), (None, ""),
            (1, a), (2, b), (3, a), (3, b), (3, c), (4, c), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] and r["doc_id"] < 9} == {
        (1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False)}
    assert sorted((str(r["component_id"]), r["kept"]) for r in got if r["doc_id"] is None) == sorted([
        ("None", True), ("None", False), ("None", False), (str(2**63 - 5), False), ("None", True), ("None", True), ("None", True)])
    left = [(r["doc_id"], r["text"]) for r in stage(spark, docs, None).collect()]
    assert sum(r in ((None, base), (None, near)) for r in left) == 1
    assert sorted(map(str, (r for r in left if r[1] not in (base, near)))) == sorted(map(str, [
        (2**63 - 5, close), (None, "alone in the world of texts"), (None, None), (None, ""), (1, a)]))


def test_a_key_with_texts_of_very_different_length_keeps_all_links(spark):
    words = [f"w{i}" for i in range(200)]
    base, long_ = " ".join(words), " ".join(f"l{i}" for i in range(70_000))
    rows = [(1, base), (2, base + " end"), (1, long_), (3, long_ + " x y z"), (4, "not like any of them at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert got == {(1, 196): (1, True), (2, 197): (1, False), (1, 69_996): (1, True), (3, 69_999): (1, False), (4, 3): (4, True)}


def test_no_step_plans_all_links_at_once(spark, monkeypatch):
    joins = []

    def counted(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return stored(df)

    for module in ("near_dup", "components"):
        monkeypatch.setattr(f"lapsewatch.llm.{module}.stored", counted)
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "x y")], "doc_id long, text string")
    last = stage(spark, docs, "")
    joins.append(last._jdf.queryExecution().optimizedPlan().toString().count("Join "))
    assert sorted(r["doc_id"] for r in last.collect()) == [1, 3]
    assert max(joins) <= 14, str(joins)
