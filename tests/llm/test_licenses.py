"""Licences: notices and wordings, cosines against a plain version, inheritance by directory, edge cases."""

import math
import re
from collections import Counter

from corpusloom.llm import licenses

SCHEMA = "doc_id long, text string, path string, own string, score double"


def plain(rows, threshold):
    """Best (licence, score, line) of each text: every passage that begins at a unit with a template's term, one by one."""
    term = lambda t: re.findall(licenses.TERM, t.lower())
    numbered = [(name, Counter(term(t))) for name, t in licenses.TEMPLATES]
    texts = [[(i, term(p)) for i, line in enumerate((t or "").split("\n")) for p in re.split(r"(?<=[.!?])[ \t]+", line) if term(p)] for _, t, *_ in rows]
    df = Counter(t for u in texts for t in {t for _, found in u for t in found})
    w2 = lambda t: (math.log((len(rows) + 1) / (df[t] + 1)) + 1) ** 2
    unseen, vocabulary = (math.log(len(rows) + 1) + 1) ** 2, {t for _, c in numbered for t in c}
    out = []
    for u in texts:
        best = None
        for name, c in numbered:
            own = sum(k * k * w2(t) for t, k in c.items())
            for i, (line, found) in enumerate(u):
                if not c.keys() & set(found):
                    continue
                passage, j = [], i
                while j < len(u) and len(passage) < sum(c.values()):
                    passage += u[j][1]
                    j += 1
                tf = Counter(passage)
                norm = sum(n * n * w2(t) if t in vocabulary else n * unseen for t, n in tf.items())
                s = round(sum(tf[t] * k * w2(t) for t, k in c.items()) / math.sqrt(own * norm), 6)
                if s >= threshold and (best is None or (s, name, -line) > best):
                    best = (s, name, -line)
        out.append(best)
    return out


_WRAPPED = "\n".join(re.findall(r".{1,70}(?:\s|$)", licenses.TEMPLATES[2][1]))
_GPL = "# " + "\n# ".join(re.findall(r".{1,60}(?:\s|$)", dict(licenses.TEMPLATES[9:10])["GPL-3.0"]))
TEXTS = [
    "some words here\nReleased under the MIT License.",
    "Licensed under the Apache License, Version 2.0\nand more text that says nothing",
    "This file is licensed under the Apache License version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
    "the license of a car is not of the kind that this work needs",
    "All rights reserved",
    "",
    None,
    "plain text\nwith lines",
    "Copyright 2020 A. Body\n\n" + _WRAPPED + "\ndef f(): pass",
    "A long line of other words that goes on. Released under the MIT License. And it goes on with other words after that.",
    _GPL + "\nimport os",
    "word " * 3000 + "\n" + "Licensed under the Apache\nLicense, Version 2.0." + "\nword" * 900,
]


def test_cosines_equal_the_plain_version(spark):
    rows = [(i, t, f"d/{i}", "clash", 0.5) for i, t in enumerate(TEXTS)]
    got = {r["id"]: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, want in enumerate(plain(rows, licenses.THRESHOLD)):
        assert (got[i]["own"], got[i]["score"], got[i]["line"]) == ((want[1], want[0], -want[2]) if want else (None, None, None)), TEXTS[i]
    assert got[0]["own"] == "MIT" and got[1]["own"] == "Apache-2.0" and got[3]["own"] == "GPL-3.0" and got[5]["own"] is None and got[0]["line"] == 1
    assert got[10]["own"] == got[11]["own"] == "MIT" and got[10]["score"] > 0.9 and got[12]["own"] == "GPL-3.0" and got[13]["own"] == "Apache-2.0"


def test_nearest_directory_holds(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, mit, "LICENSE"), (2, "x", "a/b/c.py"), (3, gpl, "a/LICENSE.txt"), (4, "x", "a/d.py"), (5, "x", "z.py"), (6, mit, "a/b/e.py"), (7, "x", "a/b/f/g.py"), (8, "x", None), (9, "x", "/a/b/h.py"), (2, "x", "a/b/c.py")]
    got = licenses.scan(spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r["id"]: (r["licence"], r["origin"], r["inherited_from"]) for r in got}
    assert by == {1: ("MIT", "own", None), 2: ("GPL-3.0", "inherited", "a"), 3: ("GPL-3.0", "own", None), 4: ("GPL-3.0", "inherited", "a"), 5: ("MIT", "inherited", ""), 6: ("MIT", "own", None), 7: ("GPL-3.0", "inherited", "a"), 8: ("MIT", "inherited", ""), 9: ("GPL-3.0", "inherited", "a")}


def test_none_and_ties(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "Licensed under CC BY 4.0.", "d/LICENSE", "x", 0.0), (2, "Released under the MIT License.", "d/COPYING", "x", 0.0), (3, "t", "d/t", "x", 0.0), (4, "t", "e", "x", 0.0)]
    by = {r["id"]: r["licence"] for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert by[3] == "CC-BY-4.0" and by[4] is None
