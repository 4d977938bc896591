import itertools
import random
import re
from re import _constants, _parser

from pyspark.sql import functions as F

from millrace.llm import license_scan


def scanned(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    return {r["doc_id"]: r for r in license_scan.summary(license_scan.scan(df)).collect()}


def test_hundreds_of_rules():
    found = license_scan.rules()
    assert len(found) > 200 and len({r[0] for r in found}) == len(found)


def test_base_places_and_labels(spark):
    got = scanned(spark, [
        "The MIT-License. mit license; MIT\nLicense", "Apache License, Version 2.0 and the GNU General Public License", None, "", "permit license commit licenses",
        "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: Apache-2.0", "All rights reserved.", "mit license " * 3,
    ])
    r = got[0]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (7, 3, 1, 5, "mit")
    r = got[1]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (2, 0, 8, "apache,gpl") and r["labels"] == "apache,apache-2.0,gpl"
    for i in (2, 3):
        assert (got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["labels"], got[i]["score"]) == (0, 0, None, "", 0.0)
    assert got[4]["n_base"] == 0 and got[4]["labels"] == ""
    assert got[5]["labels"] == "cc-by-nc" and got[6]["labels"] == "apache-2.0" and got[6]["score"] == 1.0
    assert got[7]["labels"] == "x-proprietary" and 0 < got[7]["score"] < 0.5
    assert got[8]["n_base"] == 3 and got[8]["last_word"] == 4


def test_containment_keeps_no_contained_detection(spark):
    text = "licensed under the GNU Lesser General Public License version 2.1 or the Mozilla Public License 2.0, https://www.gnu.org/licenses/gpl-3.0 " * 4
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    words = license_scan.as_words(F.col("text"))
    row = df.select(license_scan.detections(words, F.split(words, " ")).alias("d")).select("d", license_scan.kept(F.col("d")).alias("k")).first()

    def stronger(e, d):
        return e is not d and e["start"] <= d["start"] and e["end"] >= d["end"] and e["priority"] > 0 and (e["priority"], e["back"], e["rule"]) != (d["priority"], d["back"], d["rule"]) and e["priority"] <= d["priority"]

    want = [d for i, d in enumerate(row["d"]) if d["priority"] == 0 or not any(stronger(e, d) for e in row["d"][:i])]
    assert row["k"] == want and len(want) < len(row["d"])


def test_odd_rows(odd_docs, no_docs):
    assert license_scan.summary(license_scan.scan(odd_docs)).count() == odd_docs.count()
    assert license_scan.summary(license_scan.scan(no_docs)).count() == 0


def alternatives(parsed):
    """All strings that a pattern without open ends can match."""
    parts = []
    for op, arg in parsed:
        if op is _constants.LITERAL:
            parts.append([chr(arg)])
        elif op is _constants.IN:
            parts.append([c for o, a in arg for c in (map(chr, range(a[0], a[1] + 1)) if o is _constants.RANGE else [chr(a)])])
        elif op is _constants.SUBPATTERN:
            parts.append(alternatives(arg[-1]))
        elif op is _constants.BRANCH:
            parts.append([s for branch in arg[1] for s in alternatives(branch)])
        elif op is _constants.MAX_REPEAT:
            assert arg[1] == 1
            parts.append([*([""] if arg[0] == 0 else []), *alternatives(arg[2])])
        else:
            assert op is _constants.ASSERT
            parts.append([""])
    return ["".join(p) for p in itertools.product(*parts)]


def test_every_alternative_of_every_rule_holds_a_keyword():
    for _, label, _, _, keywords, pattern in license_scan.rules():
        for s in alternatives(_parser.parse(pattern.replace(license_scan._GRANT, "licensed under "))):
            assert re.search(pattern, f" {s} ") and any(k in f" {s} " for k in keywords), (label, s)


def test_every_alternative_alone_is_detected(spark):
    names = [(label, s) for label, _, name, _ in license_scan.LICENCES for s in alternatives(_parser.parse(name))]
    one = {}  # of each licence and first words, the shortest
    for label, s in sorted(names, key=lambda x: len(x[1])):
        one.setdefault((label, tuple(s.split()[:2])), s)
    texts = [f"Released under the {s} license" for s in one.values()]
    got = scanned(spark, texts)
    for i, (label, _) in enumerate(one):
        assert got[i]["labels"], texts[i]
    told = ["Licensed under the Creative Commons Attribution 4.0 license.", "Released under the Expat license", "the X11 license", "Creative Commons Zero license", "zero-clause BSD license", "Do What The Fuck You Want To Public License"]
    labels = ["cc-by", "mit", "mit", "cc0-1.0", "0bsd", "wtfpl"]
    got = scanned(spark, told)
    assert [got[i]["labels"] for i in range(len(told))] == labels


def test_wording_and_abbreviations(spark):
    told = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and": "mit",
        "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is": "isc",
        "you may not use this file except in compliance with the License.": "apache-2.0",
        "LGPL v2.1": "lgpl-2.1", "AGPLv3": "agpl-3.0", "the MPL 2.0": "mpl-2.0", "EPL 2.0": "epl-2.0", "a BSD license": "bsd", "GPL license": "gpl", "3-clause BSD license": "bsd-3-clause",
    }
    got = scanned(spark, list(told))
    assert [got[i]["labels"] for i in range(len(told))] == list(told.values())


def brute(text):
    """Every rule on every text, no keyword asked; a detection stays unless one that comes first contains it, by definition."""
    ws = re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    line = f" {' '.join(ws)} "
    found = []
    for n, label, priority, weight, _, pattern in license_scan.rules():
        for m in re.finditer(pattern, line):
            start = line[: m.start()].count(" ") - 1
            found.append((start, -(start + m[0].count(" ") + 1), priority, n, label, weight))
    found.sort()
    stay = [d for i, d in enumerate(found) if d[2] == 0 or not any(e[1] <= d[1] and 0 < e[2] <= d[2] for e in found[:i])]
    base = [d for d in stay if d[2] == 0]
    labels = lambda ds: ",".join(sorted({d[4] for d in ds}))
    starts = [d[0] for d in base]
    return len(ws), len(base), min(starts, default=None), max(starts, default=None), labels(base), labels(stay), max((d[5] for d in stay), default=0.0)


def test_equals_brute_force(spark, prose):
    r = random.Random(11)
    forms = [s for *_, pattern in license_scan.rules() for s in alternatives(_parser.parse(pattern.replace(license_scan._GRANT, "licensed under ")))[:2]]
    texts = [None, "", " ", prose(1, 5_000) + " MIT License"]
    for i in range(150):
        parts = [r.choice([r.choice(forms), r.choice(forms).title(), r.choice(forms).replace(" ", "-"), prose(i, r.randrange(12))]) for _ in range(r.randrange(1, 9))]
        texts.append(r.choice([" ", ". ", "\n"]).join(parts))
    got = scanned(spark, texts)
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:] == brute(t), t
    assert sum(bool(got[i]["labels"]) for i in got) > 100


def test_plan_is_native(odd_docs):
    plan = license_scan.summary(license_scan.scan(odd_docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
