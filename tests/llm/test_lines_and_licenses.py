import random
import re
import textwrap

import numpy as np

from lapsewatch.llm import licenses
from lapsewatch.llm.line_templates import VARIES, drop_recurring, group_lines


def test_recurring_templates_go(spark):
    footer = "Page {} of {} printed by host{} for you"
    shared = "this passage is repeated word for word in many documents of the corpus"
    rows = [(i, " ".join(f"{chr(97 + i)}{k}word" for k in "qwertyui") + f"\n{footer.format(i, 9, i)}\n{shared}\nok") for i in range(6)]
    rows += [(20, "Login failure of alice at the north gate today"), (21, "Login failure of bob at the north gate today"),
             (22, "Login failure of carol at the north gate today"), (23, "Login failure of nobody on any such door today"),
             (24, None), (25, ""), (26, "two\ntwo\ntwo"), (27, "long " * 20000), (None, shared), (0, "another text of one id\n" + shared)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, leaf string").repartition(3)
    got = {(r["doc_id"], r["n_lines"]): r for r in drop_recurring(df).collect()}
    assert len(got) == len(rows)
    for i in range(6):
        r = got[i, 4]
        assert r["n_dropped"] == 2 and r["text"] == rows[i][1].split("\n")[0] + "\nok"
    assert [got[i, 1]["n_dropped"] for i in (20, 21, 22, 23)] == [1, 1, 1, 0]
    assert got[24, 0]["text"] is None and got[25, 1]["text"] == "" and got[26, 3]["text"] == "two\ntwo\ntwo"
    assert got[27, 1]["text"] == rows[13][1] and got[None, 1]["text"] == "" and got[0, 2]["text"] == "another text of one id"
    assert drop_recurring(df.limit(0)).count() == 0


def test_exact_repeats_match_a_plain_count(spark):
    lines = ["alpha beta gamma delta", "one two three four five", "short", "epsilon zeta eta theta iota"]
    rows = [(i, "\n".join(lines[j] for j in range(4) if (i >> j) & 1)) for i in range(16)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in drop_recurring(df).collect()}
    assert kept == {i: "\n".join(x for x in t.split("\n") if len(x.split()) < 4) for i, t in rows}


def test_two_documents_are_enough(spark):
    passage = "this passage of more than eight words stands in just two documents of all"
    near = "the message for {} was sent from the north office late at night"
    rows = [(1, "first own words here\n" + passage), (2, passage + "\nsecond own words here"), (3, near.format("alice")), (4, near.format("bob")),
            (5, "only six words in this line"), (6, "only six words in this line"), (7, passage.replace("just two", "one") + "\n" + near[12:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {1: "first own words here", 2: "second own words here", 3: "", 4: "", 5: rows[4][1], 6: rows[5][1], 7: rows[6][1]}
    assert {r["doc_id"]: r["text"] for r in drop_recurring(df).collect()} == want
    assert {r["doc_id"]: r["text"] for r in drop_recurring(df, short_docs=2).collect()} == {**want, 5: "", 6: ""}
    assert {r["doc_id"]: r["text"] for r in drop_recurring(df, min_docs=3).collect()} == dict(rows)


def test_the_last_token_may_vary(spark):
    rows = [(i, f"Please report problems to {x}") for i, x in enumerate(("Bob", "Carol", "Dave"))]
    rows += [(i + 10, f"all of this is signed and sealed by {x}") for i, x in enumerate(("Bob", "Carol"))] + [(20, "Please report old bugs at once")]
    got = drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_dropped"] for r in got} == {0: 1, 1: 1, 2: 1, 10: 1, 11: 1, 20: 0}


def test_lines_that_share_no_more_than_a_beginning_stay(spark):
    ends = ["red fox that ran over the hill", "best soup I have eaten in years", "only reason why nobody should trust him",
            "last train that leaves before the storm", "old house where my uncle once lived", "first letter she wrote after the war"]
    rows = [(i, f"this is the {e}") for i, e in enumerate(ends)]
    assert {len(t.split()) for _, t in rows} == {10}
    got = drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_dropped"] == 0 for r in got)


def plain_templates(lines, similar=0.7):
    """The tree with words in place of hashes: leaf, then the template with the most equal fixed places."""
    leaves, name = {}, []
    for line in lines:
        found = leaves.setdefault((len(line), *line[:3]), [])
        agree = [sum(a == b for a, b in zip(t, line)) for t in found]
        if found and max(agree) >= similar * len(line):
            at = agree.index(max(agree))
            found[at] = [a if a == b else None for a, b in zip(found[at], line)]
        else:
            at = len(found)
            found.append(list(line))
        name.append((*line[:3], len(line), at))
    return name, leaves


def test_groups_equal_a_plain_tree():
    rng = random.Random(3)
    lines = [[rng.choice("ab"), "x", "y", *(rng.choice("pqr") for _ in range(rng.choice([4, 7])))] for _ in range(400)]
    name, leaves = plain_templates(lines)
    for leaf in leaves:
        rows = [i for i, line in enumerate(lines) if (len(line), *line[:3]) == leaf]
        number, made = group_lines(np.array([[2 * ord(w) + 1 for w in lines[i]] for i in rows]), 0.7)
        assert [name[i][-1] for i in rows] == number.tolist()
        assert [[None if t == VARIES else chr(int(t) // 2) for t in m] for m in made] == leaves[leaf]
        for i, n in zip(rows, number):  # every line agrees with its final template
            assert sum(a == b for a, b in zip(leaves[leaf][n], lines[i])) >= 0.7 * leaf[0]


def brute(text):
    """Licenses of single-sentence notices by plain search, one per line."""
    out = []
    flat = lambda s: re.sub(r"[^a-z0-9.]+|\.(?!\d)|(?<!\d)\.", " ", s.lower()).strip()
    for line in (text or "").split("\n"):
        for name, names in licenses.NAMES.items():
            if any(flat(line) == flat(n.format(x)) for n in licenses.NOTICES for x in names):
                out.append(name)
    return out


def test_notices_and_rules(spark):
    s = licenses.SENTENCES
    rows = [(1, "Some words.\nLicensed under the Apache License, Version 2.0.\nMore."), (2, "RELEASED UNDER THE MIT LICENSE"),
            (3, "This work is licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3."),
            (4, "A license to do as you like.\nno warranty."), (5, None), (6, ""), (7, "x " * 100000 + "\nReleased under the MIT License.")]
    full = [(20, " ".join(s[k] for k in ("mit-grant", "mit-notice", "as-is")), ["MIT"]),
            (21, "\n".join(s[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")), ["BSD-3-Clause"]),
            (22, "\n".join(s[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")), ["BSD-2-Clause"]),
            (23, "\n".join(s[k] for k in ("bsd-binary", "bsd-source", "bsd-grant")), []),
            (24, s["gpl3-terms"], ["GPL-3.0"]), (25, s["gpl2-terms"], ["GPL-2.0"]),
            (26, s["apache-terms"] + "\n" + s["apache-copy"], ["Apache-2.0"]), (27, "Made here. All rights reserved.", ["LicenseRef-all-rights-reserved"])]
    df = spark.createDataFrame([(i, t, "y") for i, t in rows] + [(i, t, "y") for i, t, _ in full] + [(None, "Licensed under CC0 1.0", "y")],
                               "doc_id long, text string, matches string")
    got = {r["doc_id"]: [m["license"] for m in r["matches"]] for r in licenses.licenses(df).collect()}
    assert got == {**{i: brute(t) for i, t in rows}, **{i: w for i, _, w in full}, None: ["CC0-1.0"]}
    assert licenses.licenses(df.limit(0)).count() == 0


def test_wrapped_texts_and_comments(spark):
    s = licenses.SENTENCES
    wrap = lambda *keys: "\n\n".join(textwrap.fill(s[k], 72) for k in keys)
    mark = lambda text, m, end="": "\n".join(f"{m} {x}".rstrip() + end for x in text.split("\n"))
    bsd = s["bsd-grant"], *(f"{i}. {s[k]}" for i, k in enumerate(("bsd-source", "bsd-binary", "bsd-names"), 1))
    bsd = "\n".join(textwrap.fill(x, 76, subsequent_indent="   ") for x in bsd)
    mit, header = "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + wrap("mit-grant", "mit-notice", "as-is").upper(), wrap("gpl3-terms")
    apache = ('Copyright 2020 A. Person\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in '
              "compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nMore.")
    rows = [(mit, ["MIT"], 3), (mark(mit, "#"), ["MIT"], 3), (bsd, ["BSD-3-Clause"], None), (mark(bsd, "//"), ["BSD-3-Clause"], None),
            (header, ["GPL-3.0"], 1), (wrap("gpl2-terms"), ["GPL-2.0"], None), ("/*\n" + mark(header, " *") + "\n */\nint x;", ["GPL-3.0"], 1),
            (mark(wrap("gpl2-terms"), ";;"), ["GPL-2.0"], None), (mark(header, "dnl"), ["GPL-3.0"], 1), (f"<!--\n{header} -->", ["GPL-3.0"], 1),
            (mark(header, "/*", " */"), ["GPL-3.0"], 1), (header.replace("\n", "\r\n"), ["GPL-3.0"], 1), (apache, ["Apache-2.0"], None),
            ("License: MIT License", ["MIT"], 1), ("Name: x\nLicense:\n  Apache License 2.0\nAuthor: y", ["Apache-2.0"], 1),
            ("This file is licensed\nunder the MIT License", ["MIT"], 1), ("no end\nReleased under the MIT License\nno start", ["MIT"], 1),
            ("License: none\nMIT License", [], 0), ("This file is licensed. Under the MIT License.", [], 0)]
    got = licenses.licenses(spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id long, text string")).collect()
    for r in got:
        text, names, n = rows[r["doc_id"]]
        assert [m["license"] for m in r["matches"]] == names and n in (None, r["n_known"]), (text, r)
    assert {r["doc_id"]: r["matches"][0]["sentence"] for r in got if r["matches"]}[16] == 1
