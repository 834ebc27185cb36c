import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from lapsewatch.llm import chat


def best_paths(rows, top):
    """Every root-to-leaf path by walking up from each leaf."""
    out = []
    trees = defaultdict(dict)
    for conv, msg, parent, role, text, score in rows:
        trees[conv][msg] = (parent, role, text, score or 0.0)
    for conv, nodes in trees.items():
        leaves = set(nodes) - {n[0] for n in nodes.values()}
        paths = []
        for leaf in leaves:
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(at)
                at = nodes[at][0]
            if len(path) <= len(nodes):
                paths.append((-sum(nodes[m][3] for m in path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(paths)[:top], 1):
            out.append((conv, leaf, rank, [(nodes[m][1], nodes[m][2]) for m in path]))
    return sorted(out)


def test_reply_trees(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(6):
        for m in range(1, rng.randrange(2, 40)):
            rows.append((str(conv), m, rng.choice([None, 99, *range(1, m)]) if m > 1 else None, rng.choice(["user", "assistant"]),
                         f"{conv}.{m}", rng.choice([None, 0.25, 0.5, -1.0])))
    rows += [("chain", m, m - 1, "user", str(m), 0.0) for m in range(1, 301)]
    rows += [("cycle", 1, 2, "user", "a", 0.0), ("cycle", 2, 1, "user", "b", 0.0), ("cycle", 3, 2, "user", "c", 0.0), ("cycle", 4, None, "user", "d", 0.0)]
    df = spark.createDataFrame(rows + rows[:3], "conv string, msg long, parent long, role string, text string, score double")
    for top in (1, 2):
        paths = chat.reply_paths(df, top).groupBy("conv", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("t"))
        got = sorted((r["conv"], r["leaf"], r["rank"], [(x["role"], x["text"]) for x in r["t"]]) for r in paths.collect())
        assert got == best_paths(rows, top)
    assert chat.reply_paths(df.limit(0)).count() == 0


def test_round_trip_of_control_strings(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "\\", "<\\", "[\\[", "\\<|", "<n>", "a\nb", "", None, "é😀 <<SYS>>", "<\\n>", "\\\\<"]
    rows = [(1, i, role, text) for i, (role, text) in enumerate((r, t) for r in ["user", "assistant", None, "ro\nle <n> \\"] for t in nasty)]
    rows += [(None, None, "assistant", "no id"), (2, 1, "user", "same"), (2, 1, "user", "same"), (3, 0, "assistant", "long " * 20000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv"]: r for r in chat.digest(chat.format_paths(chat.reply_paths(chat.threads(df)))).collect()}
    assert len(got) == 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    turns = [(r or "", t or "") for _, _, r, t in rows[:len(nasty) * 4]]
    learned = "".join(t for r, t in turns if r == "assistant")
    assert got["1"]["n_turns"] == len(turns) and got["1"]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
    assert (got["1"]["loss_chars"], got["1"]["loss_sha256"]) == (len(learned), sha(learned))
    assert got["2"]["n_turns"] == 2 and got["2"]["loss_sha256"] == sha("") and got["3"]["loss_chars"] == 100000
