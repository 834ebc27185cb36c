import random
import zlib

import numpy as np

from lapsewatch.llm.permutation_index import PERMUTATION, RERANKED, _Part, files_of, nearest
from lapsewatch.llm.toxicity import score


def brute(rows, q, k):
    v = dict(rows)[q]
    found = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in rows if i != q)
    return [(i, s) for s, i in found[:k]]


def test_recall_scores_and_ties(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 16))
    rows = [(i, (centres[i % 8] + 0.4 * rng.normal(size=16)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(30)]
    bad = [(5000, None), (5100, [0.0] * 16), (5200, [1.0, None] * 8), (5300, [float("nan")] + [1.0] * 15), (5400, [float("inf")] * 16), (5500, [1.0, 2.0]), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows + bad], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = nearest(df, df.where("vec_id % 100 = 0")).collect()
    queries = {i for i, _ in rows if i % 100 == 0}
    hits = 0
    for q in queries:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        want = brute(rows, q, 10)
        assert [r for r, _, _ in mine] == list(range(1, 11)) and mine == [(r, i, s) for r, (s, i) in enumerate(sorted((s, i) for _, i, s in mine), 1)]
        exact = dict(brute(rows, q, len(rows)))
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for i, _ in want})
    assert {r["query_id"] for r in got} == queries and hits >= 9 * len(queries)
    # ties of a group of copies go to the smaller ids
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 2000), key=lambda r: r["rank"])] == [0, *range(2001, 2010)]


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(df, df.where("vec_id % 100 = 0")).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 100), (100, 1, 1), (100, 2, 0)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0 and nearest(df, df.limit(0)).count() == 0


def test_prunes_and_finds(spark):
    """50 000 vectors without structure, the hardest case: few are touched, fewer compared, nine of ten neighbours found."""
    rng = np.random.default_rng(3)
    n, pivots = 50_000, 1024
    v = rng.normal(size=(n, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = np.argsort(-(v @ v[rng.choice(n, pivots, replace=False)].T), 1)[:, :PERMUTATION]
    part = _Part(near, pivots, files_of(pivots, n))
    touched, compared, hits = [], [], 0
    for i in range(0, n, 1000):
        rows = part.sharing(near[i])
        best = part.nearest(rows, near[i])
        touched.append(len(rows))
        compared.append(len(best))
        true = np.argsort(-(v @ v[i]))[1:11]
        hits += len(set(true) & set(best))
    assert np.mean(touched) <= 0.2 * n and max(compared) <= RERANKED * n + 1 and hits >= 0.9 * 500


def test_footrule_is_that_of_whole_permutations():
    rng = np.random.default_rng(4)
    pivots, keep = 40, 12
    near = np.array([rng.permutation(pivots)[:keep] for _ in range(3000)])
    part = _Part(near, pivots, 5)
    places = np.full((3000, pivots), keep)
    np.put_along_axis(places, near, np.arange(keep)[None], 1)
    rows = np.arange(3000)
    whole = np.abs(places - places[7]).sum(1)
    assert set(part.nearest(rows, near[7])) == set(np.argsort(whole, kind="stable")[:1280])
    shared = [len(set(near[7][:5]) & set(r[:5])) for r in near]
    assert part.sharing(near[7]).tolist() == [i for i, c in enumerate(shared) if c >= 2]


def test_repeated_ids_count_once(spark):
    rows = [(i % 30, [float(i), 1.0]) for i in range(60)] + [(100, [0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in nearest(df, df.where("vec_id = 100"), 40).collect())
    assert [i for _, i, _ in got] == list(range(30)) and got[0][2] == got[1][2] == 0.5


def toxic_corpus():
    rng = random.Random(5)
    syllables = ["ba", "lo", "ti", "ren", "sa", "mu", "ke", "dor"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(60)]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["idiot", "Scum", "zvorg" + word(), "zvorg" + word()])
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, int(bad)))
    return rows, labels, {i: any(w.lower() in ("idiot", "scum") or w.startswith("zvorg") for w in t.split()) for i, t in rows}


def test_learns_voters_and_holds_out(spark):
    rows, labels, truth = toxic_corpus()
    extra = [(9000, None), (9001, ""), (None, "idiot scum"), (9002, "word " * 30000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows + extra], "doc_id long, text string, score int")
    lab = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score(df, lab).collect()}
    assert len(got) == len(rows) + 4
    assert all(r["held_out"] == (zlib.crc32(str(i or "").encode() if i is None else str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(got[i]["predicted"] == int(truth[i]) for i in truth)
    assert got[9000]["predicted"] == got[9001]["predicted"] == got[9002]["predicted"] == 0 and got[None]["predicted"] == 1
    # labels of held-out rows make no difference
    flipped = spark.createDataFrame([(i, 1 - y if got[i]["held_out"] else y) for i, y in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in score(df, flipped).collect()}
    assert all(abs(again[i] - got[i]["score"]) < 1e-6 for i in truth)


def test_without_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "you idiot, you scum"), (2, "fine")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["doc_id"]: r["predicted"] for r in score(df, none).collect()} == {1: 1, 2: 0}
    assert score(df.limit(0), none).count() == 0
