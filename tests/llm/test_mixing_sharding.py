import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lapsewatch.llm import mixing, sharding


def water(sizes, weights, epochs):
    """Shares by weight; what is above a cap is shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > epochs * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = epochs * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(target.values())


def mixed(spark):
    rows, n = [], 0
    for source, docs in (("b", 3), ("a", 400), (None, 5), ("c", 40), ("Z", 2), ("é", 30), ("empty", 2)):
        for k in range(docs):
            rows.append((n, "" if source == "empty" else "w " * (1 + (k * 7) % 13), source))
            n += 1
    return rows + [(n, None, "a"), (5, rows[5][1], "a")]


@pytest.mark.parametrize("epochs", [1, 3])
def test_targets_and_sampling(spark, epochs):
    rows = mixed(spark)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(4)
    got = mixing.mix(df, epochs=epochs).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df.repartition(2), epochs=epochs).collect()))
    sizes, of = Counter(), {}
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
        of[i] = s
    want, taken, largest = water(sizes, mixing.WEIGHTS, epochs), Counter(), defaultdict(int)
    for r in got:
        s = of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] == r["size"] * r["repeats"] <= epochs * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in sizes)


def test_stage_repeats_rows(spark):
    rows = mixed(spark)
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, source string, whole int")
    plan = Counter({k: 0 for k in range(len(rows))})
    by_key = defaultdict(set)
    for r in mixing.mix(df).collect():
        by_key[r["doc_id"]].add(r["repeats"])
    out = mixing.stage(spark, df, "")
    assert out.columns == df.columns
    plan = Counter(r["whole"] for r in out.collect())
    assert all(plan[k] in by_key[r[0]] for k, r in enumerate(rows))
    assert mixing.mix(df.limit(0)).count() == 0


def check_shards(rows, got, shards):
    total, sizes, slots = 0, Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(sizes.values()) == sum(len((t or "").encode()) + 1 for _, t in rows)
    return sizes


def test_shards_are_even_and_groups_whole(spark):
    rows = [(i, f"text {i} " + "y" * (i * 37 % 400)) for i in range(3000)] + [(5000 + i, "same text of a group " * 4) for i in range(300)]
    rows += [(9000, None), (9001, ""), (None, "no id"), (7, rows[7][1]), (7, rows[7][1]), (9002, "long " * 3000)]
    df = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, shard string").repartition(7)
    got = sharding.shard(df, shards=8).collect()
    assert len(got) == len(rows)
    sizes = check_shards(rows, got, 8)
    assert max(sizes.values()) < 1.02 * sum(sizes.values()) / 8 and min(sizes.values()) > 0.98 * sum(sizes.values()) / 8
    by_text = defaultdict(set)
    for r in got:
        by_text[zlib.crc32((r["text"] or "").encode())].add(r["shard"])
    assert max(map(len, by_text.values())) == 1


def test_a_group_larger_than_a_shard_is_divided(spark):
    rows = [(i, "the same") for i in range(2000)] + [(i, f"t{i} " * 3) for i in range(2000, 3000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = check_shards(rows, got, 16)
    assert len(sizes) == 16 and max(sizes.values()) < 1.05 * sum(sizes.values()) / 16
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_without_id_that_share_one_text_are_divided(spark):
    rows = [(None, "the same text in half of all rows")] * 3000 + [(i, f"text {i} " + "y" * (i * 37 % 60)) for i in range(3000)]
    rows += [(77, "the same text in half of all rows")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).repartition(5)
    got = sharding.shard(df).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    sizes = check_shards(rows, got, 16)
    assert len(sizes) == 16 and max(sizes.values()) < 1.05 * sum(sizes.values()) / 16
    one = {r["text"]: r["shard"] for r in got if r["doc_id"] is not None and r["doc_id"] != 77}
    assert all(one[r["text"]] == r["shard"] for r in got if r["text"] in one)
