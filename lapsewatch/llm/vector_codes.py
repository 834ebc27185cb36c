"""Vector compression by codebooks of parts, trained with member-resident Lloyd rounds.

A vector becomes integers and is cut into consecutive parts; each part position has a codebook of a few entries. The
different parts with their counts are *members*: they are shuffled once to their owners, the hash partitions of
(position, entry, salt), and written there. A round reads the members where they lie. A member whose nearest entry is
still its owner's adds to the owner's sum; one whose nearest entry has changed leaves, and only such members are in the
round's shuffle, written beside the others by their new owner. A member that comes back to an owner that holds it already
does not travel again: a copy counts while its owner's entry is the nearest, so each member counts exactly once.
Owners send one sum per entry, and the driver holds nothing but codebooks.

The salt cuts an entry that holds a third of all parts into owners of about OWNER_ROWS; equal parts are combined in each
batch before the first shuffle. Everything between rounds is in written tables.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import commonest_width, finite, shuffle_partitions, stored, table
from .texts import GOLDEN, mix

POSITIONS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers are held to this; sums of squares then stay within 64 bits up to 512 components a vector.
LIMIT = 2**26
OWNER_ROWS = 4096
MEMBER = "position int, entry int, salt long, part array<int>, n long, total array<long>"

Books = list[np.ndarray]


def integers(vector: Column, scale: int = SCALE, limit: int = LIMIT) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(
        F.greatest(F.least(c * F.lit(float(scale)), F.lit(float(limit))), F.lit(float(-limit)))).cast("int"))


def _cuts(width: int) -> list[int]:
    return [width * p // POSITIONS for p in range(POSITIONS + 1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), width)


def _lists(rows: np.ndarray, kind) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.astype(kind).ravel()))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower index) and the squared distance, in whole numbers."""
    d = (book * book).sum(1)[None] - 2 * (parts @ book.T)
    at = d.argmin(1)
    return at, d[np.arange(len(d)), at] + (parts * parts).sum(1)


def _batch(position: int, entry: np.ndarray, salt: np.ndarray, n: np.ndarray, part=None, total=None) -> pa.RecordBatch:
    empty = pa.nulls(len(entry), pa.list_(pa.int32())), pa.nulls(len(entry), pa.list_(pa.int64()))
    columns = [
        pa.array(np.full(len(entry), position, np.int32)), pa.array(entry.astype(np.int32)), pa.array(salt.astype(np.int64)),
        empty[0] if part is None else _lists(part, np.int32), pa.array(n.astype(np.int64)),
        empty[1] if total is None else _lists(total, np.int64)]
    return pa.RecordBatch.from_arrays(columns, ["position", "entry", "salt", "part", "n", "total"])


def _salt(parts: np.ndarray, salts: int) -> np.ndarray:
    key = np.zeros(len(parts), np.uint64)
    for column in parts.T:
        key = mix((key ^ column.astype(np.uint64)) * GOLDEN)
    return (key % np.uint64(salts)).astype(np.int64)


def _sums(position: int, entry: np.ndarray, salt: np.ndarray, n: np.ndarray, part: np.ndarray):
    """One row per entry of a batch: count and sum of its members, sent to one of the entry's owners."""
    order = np.argsort(entry, kind="stable")
    ids, first = np.unique(entry[order], return_index=True)
    if len(ids):
        total = np.add.reduceat((part * n[:, None])[order], first, axis=0)
        yield _batch(position, ids, salt[order][first], np.add.reduceat(n[order], first), None, total)


def _members(books: Books, salts: int):
    cuts = _cuts(sum(b.shape[1] for b in books))

    def split(batches):
        for batch in batches:
            x = _matrix(batch.column(0), cuts[-1])
            for p in range(POSITIONS if len(x) else 0):
                part = x[:, cuts[p]:cuts[p + 1]]
                part, n = np.unique(part, axis=0, return_counts=True) if part.shape[1] else (part[:1], np.array([len(x)]))
                yield _batch(p, nearest(part, books[p])[0], _salt(part, salts), n, part)

    return split


def _by_position(batch: pa.RecordBatch):
    position = batch.column(0).to_numpy()
    for p in np.unique(position):
        rows = batch.filter(pa.array(position == p))
        entry, salt, n = (rows.column(i).to_numpy() for i in (1, 2, 4))
        yield int(p), rows, entry, salt, n


def _settle(batches):
    """At the owners: members pass, and their sums are added; sums of earlier members pass."""
    for batch in batches:
        yield batch
        arrived = batch.filter(pa.compute.is_valid(batch.column(3)))
        for p, rows, entry, salt, n in _by_position(arrived):
            yield from _sums(p, entry, salt, n, rows.column(3).flatten().to_numpy().astype(np.int64).reshape(len(n), -1))


def _round(history: list[Books]):
    """Sums of the members that stay with their owner, and the members that leave, addressed to their new owner."""
    *before, now = history

    def move(batches):
        for batch in batches:
            for p, rows, entry, salt, n in _by_position(batch):
                part = rows.column(3).flatten().to_numpy().astype(np.int64).reshape(len(n), -1)
                target = nearest(part, now[p])[0]
                stays = target == entry
                yield from _sums(p, entry[stays], salt[stays], n[stays], part[stays])
                left = np.flatnonzero(~stays)
                left = left[nearest(part[left], before[-1][p])[0] == entry[left]]
                for books in before:  # an owner that it had before still holds a copy
                    left = left[nearest(part[left], books[p])[0] != target[left]]
                yield _batch(p, target[left], salt[left], n[left], part[left])

    return move


def _owned(moved: DataFrame) -> DataFrame:
    return moved.repartition(shuffle_partitions(moved.sparkSession), "position", "entry", "salt")


def _updated(sums: DataFrame, books: Books) -> Books:
    """Entries replaced by floor(sum / count); an entry without members stays. One row per entry reaches the driver."""
    per = sums.where(F.col("total").isNotNull()).select("position", "entry", "n", F.posexplode_outer("total").alias("i", "x"))
    rows = per.groupBy("position", "entry", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    new = [b.copy() for b in books]
    for r in rows:
        if r["i"] is not None:
            new[r["position"]][r["entry"], r["i"]] = r["x"] // r["n"]
    return new


def train(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, key: str = "vec_id", vector: str = "embedding") -> Books:
    """One codebook per part position, after ``rounds`` Lloyd rounds from the first ``entries`` vectors by id.

    Vectors that are null or hold null or non-finite components take no part, nor do those whose length is not the
    commonest one (ties to the longer). Components saturate at LIMIT after scaling. Starts are ordered by id, equal
    ids by vector, null ids last; fewer vectors give shorter codebooks, none gives no codebook ([]). A length that
    is no multiple of POSITIONS gives parts that differ by one component. Repeated rows count as often as they stand.
    """
    spark = vectors.sparkSession
    rows = _rows(vectors, key, vector)
    width, count = commonest_width(rows, "x")
    if not count:
        return []
    rows = rows.where(F.size("x") == width)
    first = rows.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r["x"] for r in first], np.int64).reshape(len(first), width)
    cuts = _cuts(width)
    history = [[x[:, a:b] for a, b in zip(cuts, cuts[1:])]]
    members = _owned(rows.select("x").mapInArrow(_members(history[0], -(-count // OWNER_ROWS)), MEMBER))
    members = members.groupBy("position", "entry", "salt", "part").agg(F.sum("n").alias("n"))
    tables = [stored(members.withColumn("total", F.lit(None).cast("array<bigint>")).mapInArrow(_settle, MEMBER))]
    for r in range(rounds):
        if r:
            held = reduce(DataFrame.unionByName, [t.where(F.col("part").isNotNull()) for t in tables])
            tables.append(stored(_owned(held.mapInArrow(_round(history), MEMBER)).mapInArrow(_settle, MEMBER)))
        history.append(_updated(tables[-1], history[-1]))
        if all(np.array_equal(a, b) for a, b in zip(*history[-2:])):
            break
    return history[-1]


def _rows(vectors: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    kept = vectors.where(finite(F.col(vector)))
    return kept.select(F.col(key).alias("id"), *[F.col(c).alias(f"_{c}") for c in more], integers(F.col(vector)).alias("x"))


def digest(books: Books) -> str:
    """SHA-256 of all components, by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: Books, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, label, code, error) of the vectors that fit the codebooks; the names are those given. One scan, no shuffle."""
    rows = _rows(vectors, key, vector, label)
    kinds = dict(rows.dtypes)
    kind = f"id {kinds['id']}, label {kinds[f'_{label}']}, code string, error long"
    if not books:
        out = rows.where("false").select("id", F.col(f"_{label}").alias("label"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        width = sum(b.shape[1] for b in books)
        out = rows.where(F.size("x") == width).mapInArrow(_encoded(books, _cuts(width)), kind)
    return out.toDF(key, label, "code", "error")


def _encoded(books: Books, cuts: list[int]):
    def code(batches):
        for batch in batches:
            x = _matrix(batch.column(2), cuts[-1])
            at, error = np.zeros((len(x), POSITIONS), np.uint8), np.zeros(len(x), np.int64)
            for p, book in enumerate(books):
                at[:, p], d = nearest(x[:, cuts[p]:cuts[p + 1]], book)
                error += d
            codes = pa.array([row.tobytes().hex() for row in at], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, pa.array(error)], ["id", "label", "code", "error"])

    return code


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all embeddings, the error of their label, and the digest of the codebooks.

    A label's error is the sum over its rows, null where it exceeds 64 bits; rows without a label are one group.
    """
    vectors = table(spark, sf_dir, "embeddings")
    books = train(vectors)
    codes = stored(encode(vectors, books))
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds for DuckDB, one pair of common tables a round."""
    steps = [f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS (
  SELECT r, p, list_slice(x, p * (len(x) // {POSITIONS}) + 1, (p + 1) * (len(x) // {POSITIONS})) AS v
  FROM kept, range({POSITIONS}) AS t(p)),
b0 AS (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS (
  SELECT r, parts.p, any_value(parts.v) AS v, min(struct_pack(
    d := list_sum(list_transform(list_zip(parts.v, b{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := e)) AS best
  FROM parts JOIN b{i} ON parts.p = b{i}.p GROUP BY r, parts.p)""")
        if i < ROUNDS:
            steps.append(f"""b{i + 1} AS (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS v FROM (
      SELECT p, best.e AS e, i, floor(sum(v[i]) / count(*))::BIGINT AS x
      FROM a{i}, range(1, 1 + (SELECT max(len(v)) FROM parts)) AS t(i) GROUP BY p, best.e, i) GROUP BY p, e) m
  ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH {", ".join(steps)},
coded AS (
  SELECT kept.vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM kept JOIN a{ROUNDS} a ON kept.r = a.r GROUP BY kept.r, kept.vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded"""


SQL = _sql()
