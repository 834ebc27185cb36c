"""MinHash near-duplicates by an inverted join over signature coordinates.

Each distinct shingle set gets a MinHash signature. Every (coordinate, value) pair is a token with a posting list.
Two signatures that agree in MATCHES of COORDINATES places share one of their COORDINATES - MATCHES + 1 rarest
tokens (prefix filter), so only these are posted; the long lists of frequent tokens are skipped. Agreement in 82 of
128 places keeps a pair of similarity 0.8 with probability 1 - 2e-6.

Collisions are counted inside bundles instead of emitting the pairs of a list: the most central member of a list (whose
tokens are the most frequent) is its hub, and every member joins the bundle of its most central hub. A bundle is
compared exactly, block against block, each pair of blocks in its own task; only a spanning forest of the links
is returned. Members of a list that ended up in another bundle than its hub are compared with the whole list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .tables import stored, table
from .texts import pieces, shingle_sets, texts_of, words_of

COORDINATES, MATCHES = 128, 82
WIDTH, PERCENT = 5, 80
#: Signature places that a hub and a member must share to be bundled; decides only where pairs are compared.
NEAR_HUB = COORDINATES // 4
#: Shingles in a block of a bundle; bounds a task's memory, not the result.
BLOCK = 65_536
SEED = 20_240_601
#: What makes two shingle sets the same one.
SAME_SET = ["n_shingles", "print_a", "print_b"]


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = rng.integers(0, 2**64, (2, COORDINATES), np.uint64, endpoint=False)
    return draw[0] | np.uint64(1), draw[1]


def _identity(sets: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """The columns SAME_SET of sets given one after the other: size and two 64-bit prints, null for an empty set."""
    size = np.diff(bounds)
    some = np.flatnonzero(size)
    prints = np.zeros((2, len(size)), np.uint64)
    if len(some):
        prints[0, some] = np.add.reduceat(sets, bounds[:-1][some])
        prints[1, some] = np.bitwise_xor.reduceat(sets * _permutations()[0][0], bounds[:-1][some])
    return [pa.array(size, pa.int64()), *(pa.array(p.view(np.int64), mask=size == 0) for p in prints)]


def _sign(width: int, keys: list[str]):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, flip = _permutations()
        for batch in pieces(batches, "text"):
            sets, bounds = shingle_sets(words_of(texts_of(batch, "text")), width)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            begin = bounds[:-1][some]
            low = np.zeros((len(some), COORDINATES), np.uint32)
            if len(some):
                for k in range(COORDINATES):
                    low[:, k] = np.minimum.reduceat((sets ^ flip[k]) * times[k], begin) >> np.uint64(32)
            offsets = np.concatenate(([0], np.cumsum(np.where(size > 0, COORDINATES, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(k)) for k in keys), *_identity(sets, bounds),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(low.ravel().view(np.int32)))],
                [*keys, *SAME_SET, "signature"])

    return sign


def _sets(width: int):
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets, bounds = shingle_sets(words_of(texts_of(batch, "text")), width)
            yield pa.RecordBatch.from_arrays(
                [*_identity(sets, bounds),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))],
                [*SAME_SET, "shingles"])

    return sets_of


def overlaps(flat: np.ndarray, sizes: np.ndarray, step: int = 2048) -> np.ndarray:
    """Sizes of the pairwise intersections of sets given one after the other, counted ``step`` elements at a time."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    at, owner = number[at[keep]], owner[keep]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    total = int(shared.sum())
    out = np.zeros((len(sizes), len(sizes)), np.float32)
    cuts = np.searchsorted(at, np.arange(0, total + step, step))
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        part = np.zeros((len(sizes), step), np.float32)
        part[owner[a:b], at[a:b] - i * step] = 1
        out += part @ part.T
    return out


def _forest(percent: int):
    def forest(group: pa.Table) -> pa.Table:
        """A spanning forest of the links between the two blocks of a group, or within its one block."""
        group = group.combine_chunks()
        docs, block = group["set"].to_numpy(), group["block"].to_numpy()
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        lists = group["shingles"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        same = overlaps(flat, sizes).astype(np.int64)
        link = 100 * same >= percent * (sizes[:, None] + sizes[None, :] - same)
        np.fill_diagonal(link, False)
        if i != j:
            link &= block[:, None] != block[None, :]
        left = np.ones(len(docs), bool)
        u, v = [], []
        for start in range(len(docs)):
            if not left[start]:
                continue
            left[start] = False
            reached = [start]
            while reached:
                at = reached.pop()
                new = np.flatnonzero(link[at] & left)
                left[new] = False
                reached += new.tolist()
                u += [docs[at]] * len(new)
                v += docs[new].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return forest


def _agree(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are lower-cased (A-Z) and split at spaces and control characters 9 to 13; a text with fewer than ``width``
    words is one shingle. Two documents are linked if 100 * intersection >= percent * union of their shingle sets.
    A null text or one without words has no shingles and no links, but its key may have other texts. Rows with equal keys are
    one document, in the component of all its texts. A row with a null key is a document of its own, linked like any other,
    but its key is never the smallest: it has the component of the documents it is linked to. Where all of these have null
    keys, the component is null and one row of them is kept. An empty table gives no rows.
    """
    return _judged(docs, key, text, width, percent).select(F.col("doc").alias(key), "n_shingles", "component_id", "kept")


def node(key: Column, text: Column) -> Column:
    """The key, or a number made from the text where it is null."""
    return F.coalesce(key, F.lit(1 << 62).cast("long") + F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1).cast("long")))


def _judged(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(doc, node, n_shingles, component_id, kept) for every row of ``docs``; null keys have nodes by their text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    rows = rows.select(node(F.col("doc"), F.col("text")).alias("doc"), F.col("doc").isNotNull().alias("named"), "text")
    signed = stored(rows.mapInArrow(
        _sign(width, ["doc", "named"]), "doc long, named boolean, n_shingles long, print_a long, print_b long, signature array<int>"
    ).withColumn("row", F.monotonically_increasing_id()))
    # sets are compared, not documents; a set has the number of its first row, and its smallest key where a row of it has one
    sets = stored(signed.where("n_shingles > 0").groupBy(*SAME_SET).agg(
        F.min(F.struct((~F.col("named")).alias("unnamed"), "doc", "row")).alias("first")).select(
        *SAME_SET, F.col("first.row").alias("set"), F.col("first.doc").alias("rep"), (~F.col("first.unnamed")).alias("named_rep")))
    reps = signed.join(sets.select(F.col("set").alias("row")), "row", "left_semi").withColumnRenamed("row", "set")

    tokens = reps.select("set", F.posexplode("signature").alias("place", "value")).select(
        "set", ((F.col("place").cast("long") * F.lit(1 << 32)) + F.col("value")).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    of_set = Window.partitionBy("set")
    ranked = tokens.join(shared, "token").withColumns({
        "place": F.row_number().over(of_set.orderBy("df", "token")), "n": F.count("*").over(of_set),
        "central": F.sum(F.log("df")).over(of_set)})
    posted = stored(ranked.where(F.col("place") <= F.lit(COORDINATES - MATCHES + 1) - (COORDINATES - F.col("n"))).select(
        "token", "set", "central"))

    # one hub for each list: the most central member, ties to the smaller document
    hubs = posted.groupBy("token").agg(
        F.max(F.struct("central", (-F.col("set")).alias("minus"))).alias("top"), F.count("*").alias("members")
    ).where("members > 1").select("token", F.col("top.central").alias("hub_central"), (-F.col("top.minus")).alias("hub"))
    listed = posted.join(hubs, "token").select("token", "set", "hub", "hub_central")
    stars = listed.where("set <> hub").groupBy("set", "hub").agg(F.max("hub_central").alias("hub_central"))
    sig = reps.select("set", "signature")
    near = stars.join(sig, "set").join(sig.select(F.col("set").alias("hub"), F.col("signature").alias("other")), "hub").where(
        _agree(F.col("signature"), F.col("other")) >= NEAR_HUB)
    first = stored(near.groupBy("set").agg(F.max(F.struct("hub_central", (-F.col("hub")).alias("minus"))).alias("top")).select(
        "set", "top.hub_central", (-F.col("top.minus")).alias("hub")))
    # a member follows its hub one step on, if that hub is itself in the bundle of a more central one
    second = first.select(F.col("set").alias("hub"), F.col("hub_central").alias("c2"), F.col("hub").alias("h2"))
    own = F.col("hub_central")
    followed = first.join(second, "hub", "left").select("set", F.when(F.col("c2") > own, F.col("h2")).otherwise(F.col("hub")).alias("bundle"))
    members = stored(listed.select("set").distinct().join(followed, "set", "left").select(
        "set", F.coalesce("bundle", "set").alias("bundle")))

    chosen = sets.join(members.select("set"), "set", "left_semi")
    wanted = rows.join(chosen.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
    read = wanted.mapInArrow(_sets(width), "n_shingles long, print_a long, print_b long, shingles array<long>").where("n_shingles > 0")
    shingles = stored(read.dropDuplicates(SAME_SET).join(chosen.select(*SAME_SET, "set"), SAME_SET).select("set", "shingles"))

    # links are stored kind by kind: the driver plans anew after each shuffle, over the whole plan of the table it writes
    # within bundles: blocks in the order of set size, so that blocks of too different sizes need no comparison
    running = Window.partitionBy("bundle").orderBy("n_shingles", "set").rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(members.join(sets.select("set", "n_shingles"), "set").withColumn(
        "block", F.floor(F.sum(F.col("n_shingles") + 64).over(running) / BLOCK)))
    blocks = placed.groupBy("bundle", "block").agg(
        F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"), F.count("*").alias("n"))
    later = blocks.select("bundle", F.col("block").alias("j"), F.col("low").alias("low_j"), F.col("n").alias("n_j"))
    pairs = blocks.join(later, "bundle").where(
        (F.col("block") <= F.col("j")) & (100 * F.col("high") >= percent * F.col("low_j"))
        & ((F.col("block") < F.col("j")) | (F.col("n") > 1))).select("bundle", F.col("block").alias("i"), "j")
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    compared = placed.select("set", "bundle", "block").join(sides, ["bundle", "block"]).join(shingles, "set")
    within = stored(compared.groupBy("bundle", "i", "j").applyInArrow(_forest(percent), "u long, v long"))

    # across bundles: those that left a list's own bundle, against the whole list
    at = listed.join(members, "set").join(
        members.select(F.col("set").alias("hub"), F.col("bundle").alias("main")), "hub").select("token", "set", "bundle", "main")
    outside = at.where("bundle <> main").select("token", F.col("set").alias("u"), F.col("bundle").alias("of_u"))
    across = outside.join(at.select("token", F.col("set").alias("v"), F.col("bundle").alias("of_v")), "token").where(
        "of_u <> of_v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    one, two = (sig.select(F.col("set").alias(c), F.col("signature").alias(f"s_{c}")) for c in ("u", "v"))
    alike = stored(across.join(one, "u").join(two, "v").where(_agree(F.col("s_u"), F.col("s_v")) >= MATCHES).select("u", "v"))
    one, two = (shingles.select(F.col("set").alias(c), F.col("shingles").alias(f"s_{c}")) for c in ("u", "v"))
    both = F.size(F.array_intersect("s_u", "s_v"))
    exact = stored(alike.join(one, "u").join(two, "v").where(
        100 * both >= percent * (F.size("s_u") + F.size("s_v") - both)).select("u", "v"))

    # rows of one key with different texts are one document: all its sets are linked to its first one
    classed = stored(signed.select("doc", "named", "row", *SAME_SET).join(sets, SAME_SET, "left").select(
        "doc", "named", "row", "n_shingles", "set", "rep", "named_rep"))
    by_key = classed.where("named").groupBy("doc").agg(
        F.min("set").alias("lo"), F.max("set").alias("hi"), F.max(F.col("set").isNull()).alias("empty"))
    several = by_key.where("lo < hi").select("doc", "lo")
    twice = stored(classed.where("named").join(several, "doc").where("set <> lo").select(
        F.col("lo").alias("u"), F.col("set").alias("v")).distinct())
    found = components(within.unionByName(exact).unionByName(twice))
    found = found.unionByName(found.select(F.col("component").alias("vertex"), "component").distinct())

    # a component goes by its smallest key; a row without words goes with the other texts of its key
    smallest = found.join(sets.where("named_rep").select(F.col("set").alias("vertex"), "rep"), "vertex").groupBy(
        "component").agg(F.min("rep").alias("least"))
    linked = stored(found.join(smallest, "component", "left").withColumnRenamed("vertex", "set"))
    out = classed.where("set IS NOT NULL").join(linked, "set", "left")
    other = by_key.where("empty AND lo IS NOT NULL").select("doc", F.col("lo").alias("set")).join(
        sets.select("set", "rep"), "set").join(linked, "set", "left").select(
        "doc", F.lit(True).alias("named"), F.coalesce("component", "set").alias("component"), F.coalesce("least", "rep").alias("least"))
    empty = classed.where("set IS NULL").join(other, ["doc", "named"], "left")
    judged = out.unionByName(empty).withColumn("component_id", F.when(F.col("component").isNotNull(), F.col("least")).when(
        F.coalesce("named_rep", "named"), F.coalesce("rep", "doc")))
    first = F.col("set").isNull() | ((F.col("row") == F.col("set")) & (F.col("set") == F.coalesce("component", "set")))
    return judged.select(F.when(F.col("named"), F.col("doc")).alias("doc"), F.col("doc").alias("node"), "n_shingles", "component_id", F.when(
        F.col("named"), F.col("doc") == F.col("component_id")).otherwise(F.col("component_id").isNull() & first).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; repeated rows of it stay as they are. Of a group
    without ids one row stays; rows without id and words stay as they are."""
    kept = stored(_judged(docs, "doc_id", "text", WIDTH, PERCENT).where("kept").select(
        F.col("node").alias("_node"), F.col("doc").isNotNull().alias("_named"), (F.col("n_shingles") > 0).alias("_words")))
    named, unnamed = kept.where("_named").select("_node").distinct(), kept.where("NOT _named").distinct()
    some = docs.where("doc_id IS NOT NULL").join(named, F.col("doc_id").cast("long") == F.col("_node"), "left_semi")
    rest = docs.where("doc_id IS NULL").withColumn("_at", node(F.col("doc_id").cast("long"), F.col("text").cast("string"))).join(
        unnamed, F.col("_at") == F.col("_node"))
    one = rest.where("_words").dropDuplicates(["_at"])
    return some.unionByName(one.unionByName(rest.where("NOT _words")).select(*docs.columns))
