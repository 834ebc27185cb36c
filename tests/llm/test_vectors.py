import hashlib

import numpy as np
import pytest

from lapsewatch.llm import vector_codes, whitening

NAN, INF = float("nan"), float("inf")
KIND = "vec_id long, embedding array<double>, label int, entry int, position string, part int, x int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, "a", 2, 3, 4) for i, v, y in rows], KIND).repartition(3)


def lloyd(rows, rounds=6, entries=16):
    """Plain Lloyd rounds, vector by vector, in Python's whole numbers."""
    x = [([int(np.floor(4096 * c)) for c in v], i, y) for i, v, y in rows]
    x.sort(key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    w = len(x[0][0]) // 8
    parts = [[r[0][p * w:(p + 1) * w] for r in x] for p in range(8)]
    books = [[list(v) for v in column[:entries]] for column in parts]
    best = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            owned = {}
            for v in parts[p]:
                owned.setdefault(best(v, books[p])[1], []).append(v)
            for k, vs in owned.items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for row, (_, i, y) in enumerate(x):
        found = [best(parts[p][row], books[p]) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), y))
    text = ",".join(str(c) for book in books for e in book for c in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def vectors(n, width, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    return [(i, (0.2 * (centres[i % 5] + rng.normal(size=width))).tolist(), i % 3 or None) for i in range(n)]


def coded(spark, rows):
    df = frame(spark, rows)
    books = vector_codes.train(df)
    return sorted(map(str, map(tuple, vector_codes.encode(df, books).select("vec_id", "code", "error", "label").collect()))), books


def test_rounds_equal_plain_lloyd(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "OWNER_ROWS", 50)  # many salts
    rows = vectors(700, 16)
    rows += [(900 + i, rows[3][1], 7) for i in range(300)] + [rows[5], rows[5], (None, rows[6][1], 1), (None, rows[7][1], None)]
    bad = [(2000, None, 1), (-5, [NAN] + [0.0] * 15, 1), (-6, [None] * 16, 1), (-7, [INF] * 16, 1), (-8, [1.0, 2.0], 1), (-9, [], 1)]
    got, books = coded(spark, rows + bad)
    want, digest = lloyd(rows)
    assert got == sorted(map(str, want)) and vector_codes.digest(books) == digest


def test_members_that_leave_and_return(spark):
    """Every round's members add up, whichever owners they went through."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.integers(-3, 4, size=8) / 4096], 0) for i in range(400)]
    for rounds in (1, 2, 3, 6):
        df = frame(spark, rows)
        assert vector_codes.digest(vector_codes.train(df, rounds=rounds)) == lloyd(rows, rounds)[1]


def test_few_rows_and_extremes(spark):
    for rows in ([(3, [0.5] * 8, None)], vectors(5, 24, 1), [(i, [1.0] * 16, 1) for i in range(40)]):
        got, books = coded(spark, rows)
        want, digest = lloyd(rows)
        assert got == sorted(map(str, want)) and vector_codes.digest(books) == digest
    got, books = coded(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (3, [0.0] * 8, None)])
    assert [str(b[0].tolist()) for b in books] == [str([vector_codes.LIMIT])] * 8 and len(got) == 3
    got, books = coded(spark, [(1, [0.1 * i for i in range(11)], 1), (2, [0.2] * 11, 1)])
    assert sum(b.shape[1] for b in books) == 11 and len(got) == 2


def test_empty_tables(spark, tmp_path):
    got, books = coded(spark, [])
    assert got == [] and books == []
    frame(spark, [(1, None, 2)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert vector_codes.query(spark, str(tmp_path)).count() == whitening.query(spark, str(tmp_path)).count() == 0


def test_label_errors(spark, tmp_path):
    rows = vectors(60, 8, 2)
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, digest = lloyd(rows)
    sums = {}
    for _, _, e, y in want:
        sums[y] = sums.get(y, 0) + e
    got = vector_codes.query(spark, str(tmp_path)).collect()
    assert {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got} == {(i, c, e, sums[y]) for i, c, e, y in want}
    assert {r["codebooks_sha256"] for r in got} == {digest}


def exact(rows, k):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v, _ in rows], object)
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(fit), fit.sum(0)
    centred = ((n * fit - sums) / n).astype(float)
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1][:k], vectors_[:, ::-1][:, :k]
    white = ((n * x - sums) / n).astype(float) @ vectors_ / np.sqrt(values)
    return n, ((n * x - sums) ** 2).sum(1), white, values / (centred ** 2).sum() * n


@pytest.mark.parametrize("width", [8, 96])
def test_whitening_equals_dense_eigenvectors(spark, tmp_path, width):
    rows = [(i, v, y) for i, v, y in vectors(600, width, 3)]
    rows += [(1000 + i, rows[1][1], 1) for i in range(200)] + [rows[2], (None, rows[4][1], 1)]
    bad = [(2000, None, 1), (2001, [NAN] + [0.0] * (width - 1), 1), (2002, [None] * width, 1), (2003, [1.0], 1), (2004, [], 1)]
    frame(spark, rows + bad).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.query(spark, str(tmp_path)).collect()
    k = min(16, width)
    n, deviation, white, explained = exact(rows, k)
    assert len(got) == k * len(rows) and {r["n"] for r in got} == {n}
    assert all(r["identity_error"] < 1e-10 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    for c in range(1, k + 1):
        sign = np.sign(by[c][0][0]["whitened"] * white[0, c - 1])
        for (i, _, _), d, w in zip(rows, deviation, white[:, c - 1]):
            for r in by[c][i]:
                assert r["deviation"] == d and abs(r["whitened"] * sign - w) < 1e-7
                assert abs(r["explained"] / explained[c - 1] - 1) < 1e-9


def test_whitening_of_low_rank_flat_and_huge(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 5.0], 1) for i in range(30)]
    model = whitening.fit(frame(spark, rows))
    assert len(model.values) == 1 and model.identity_error < 1e-10
    assert whitening.whiten(frame(spark, rows), model).count() == 30
    same = frame(spark, [(i, [1.0, 2.0], 1) for i in range(5)])
    model = whitening.fit(same)
    assert model.n == 1 and len(model.values) == 0 and whitening.whiten(same, model).count() == 0
    huge = frame(spark, [(1, [1e300, 0.0], 1), (2, [-1e300, 1.0], 1), (3, [0.0, 2.0], 1)])
    got = whitening.whiten(huge, whitening.fit(huge)).collect()
    assert got and any(r["deviation"] is None for r in got)


def test_iteration_of_a_flat_spectrum():
    """All eigenvalues within a thousandth: the block grows until the pairs are certified."""
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(200, 200)))[0]
    v = (q * (1 + rng.random(200) / 1000)) @ q.T
    pairs, values, residual = whitening._eigenpairs(lambda b: v @ b, 200, 16, rng)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:16]
    assert np.abs(values - want).max() < 1e-9 and residual <= whitening.CERTIFIED * want[0]
    assert np.abs(pairs.T @ pairs - np.eye(16)).max() < 1e-12
