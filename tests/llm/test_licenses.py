from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import licenses

NOTICE = "Licensed under the Apache License, Version 2.0."


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*", text.lower())


def telling(i: int) -> set[str]:
    """Words that tell a notice from those of other licences."""
    name, text = licenses.TEMPLATES[i]
    others = {w for n, t in licenses.TEMPLATES if n != name for w in words(t)}
    own = set(words(text)) - others
    return own or {w for w in words(text) if re.search("[0-9]", w)} or set(words(text))


def plain(rows: list) -> dict:
    """Whole texts, segments and all windows against every template, one by one; then a walk up the path."""
    n = len(rows)
    df = Counter(w for _, _, t in rows for w in set(words(t or "")))
    weigh = lambda run: {w: c * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in Counter(run).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def cosine(run: list[str], template: dict) -> float:
        v = weigh(run)
        return sum(x * template.get(w, 0) for w, x in v.items()) / (norm(v) * norm(template)) if v else 0.0

    def windows(run: list[str], length: int) -> list[list[str]]:
        return [run[s : s + length] for s in range(len(run) - length + 1)] if len(run) > length else [run]

    short, titles, long = ([(name, words(t), weigh(words(t))) for name, t in group] for group in (licenses.TEMPLATES, licenses.TITLES, licenses.long_templates()))

    def own_license(text: str) -> tuple | None:
        run = words(text)
        found = [
            (-max(cosine(w, v) for w in windows(run, len(own))), name)
            for name, own, v in long
            if sum(x * x for w, x in v.items() if w in set(run)) >= 0.63 * norm(v) ** 2  # no window can do better than its shared words
        ]
        found = [f for f in found if round(-f[0], 9) >= 0.8]
        if not found:
            for segment in map(words, licenses.segments(text)):
                for i, (name, own, v) in enumerate(short):
                    found.append((-cosine(segment, v), name))
                    if len(segment) > len(own):
                        found += [(-cosine(w, v), name) for w in windows(segment, len(own)) if telling(i) & set(w)]
                found += [(-cosine(segment, v), name) for name, own, v in titles if set(own) <= set(segment)]
            found = [f for f in found if round(-f[0], 9) >= 0.6]
        best = min(((round(c, 9), name) for c, name in found), default=None)
        return best and (-best[0], best[1])

    own = {i: own_license(text or "") for i, _, text in rows}
    files = {}
    for i, path, _ in sorted(rows, key=lambda r: r[1] or ""):
        if path and own[i] and re.match(licenses.LICENSE_FILE, path.split("/")[-1]):
            files.setdefault("/".join(path.split("/")[:-1]), own[i][1])
    out = {}
    for i, path, _ in rows:
        inherited = None
        if not own[i] and path is not None:
            up = path.split("/")[:-1]
            while inherited is None:
                inherited = files.get("/".join(up))
                if not up:
                    break
                up = up[:-1]
        out[i] = (own[i] and own[i][1], own[i][1] if own[i] else inherited, "own" if own[i] else "directory" if inherited else "none")
    return out, {i: best and best[0] for i, best in own.items()}


def test_matches_brute_force(spark, texts):
    rows = [(i, f"src{i % 3}/d{i % 7}/f{i}.txt", t) for i, t in enumerate(texts)]
    extra = [
        ("LICENSE", "Released under the MIT License."),
        ("src0/LICENSE.md", NOTICE),
        ("src0/d1/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("src0/d1/LICENSE", "nothing of the kind"),
        ("src0/d1/deep/er/file", "x"),
        ("src2/d2/notice.txt", "Some words.\n\nPermission is hereby granted, free of charge,\nto any person obtaining a copy of this\nsoftware and associated documentation files (the Software)"),
        (None, "no path"),
        ("/abs/file", "x"),
        ("top", "under the license and the terms of the public version"),
        ("end", "# " + NOTICE.upper() + " See LICENSE for more."),
        ("cc/a", "Licensed under CC BY-NC 4.0.\nwords"),
        ("win/a", "This project of many authors is, as the file beside it says, released under the MIT License, and further words follow on this line."),
        ("win/b", "Copyright 2021 Example Authors. Licensed under the Apache License, Version 2.0. More of the same follows here."),
        ("win/LICENCE.txt", dict(licenses.long_templates())["ISC"]),
        ("win/c/head.py", "# Copyright 2021\n" + dict(licenses.long_templates())["BSD-2-Clause"] + "\nimport os\n" * 40),
        ("win/d", "ISC License\n\nand more"),
        ("win/e", "Apache License\nsomething else entirely follows here today"),
        ("win/f", "GNU General Public License"),
    ]
    rows += [(1000 + i, p, t) for i, (p, t) in enumerate(extra)]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("clash"))
    scanned = licenses.scan(frame).collect()
    found = {r.doc_id: (r.own_license, r.license, r.license_from) for r in scanned}
    expected, cosines = plain(rows)
    assert found == expected
    assert {r.doc_id: r.cosine for r in scanned} == {i: c if c is None else pytest.approx(c, abs=1e-7) for i, c in cosines.items()}
    assert {"own", "directory"} == {x for _, _, x in found.values() if x != "none"}


def test_no_rows_and_repeated_rows(spark, no_docs):
    assert licenses.scan(no_docs, path="source").count() == 0
    twice = spark.createDataFrame([(1, "a/LICENSE", NOTICE)] * 2 + [(2, "a/b/c", None)] * 2, "doc_id long, path string, text string")
    assert [r.license for r in licenses.scan(twice).collect()] == ["Apache-2.0"] * 4


OPENING = "This {work} is free software; you can redistribute it and/or modify\nit under the terms of the {title} as published by\nthe Free Software Foundation; either version {v} of the License, or\n(at your option) any later version.\n"


def test_whole_texts_headers_and_titles(spark, texts):
    whole = dict(list(licenses.long_templates())[:12])
    assert set(whole) >= {"AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "MIT"}
    cases = [(name, text) for name, text in whole.items()]
    cases += [(name, "Copyright (c) 2021, Example Authors\nAll rights reserved.\n\n" + text) for name, text in whole.items()]
    cases += [(name, "/*\n * Copyright 2021\n *\n * " + whole[name].replace("\n", "\n * ") + "*/\nint main;\n" + "x = y;\n" * 200) for name in ("BSD-2-Clause", "BSD-3-Clause", "ISC")]
    cases += [
        ("GPL-2.0", "# " + OPENING.format(work="program", title="GNU General Public License", v="2").replace("\n", "\n# ") + "\nimport os\n" * 30),
        ("GPL-3.0", OPENING.format(work="program", title="GNU General Public License", v="3")),
        ("LGPL-2.1", OPENING.format(work="library", title="GNU Lesser General Public License", v="2.1")),
        ("AGPL-3.0", OPENING.format(work="program", title="GNU Affero General Public License", v="3")),
        ("ISC", "ISC License\n\nand more"),
        ("Apache-2.0", "Apache License\nsomething else entirely follows here today"),
        ("MPL-2.0", "Mozilla Public License Version 2.0\n======"),
        (None, "License\n"),
        (None, "Redistribution"),
    ]
    rows = [(i, "a/b", t) for i, (_, t) in enumerate(cases)] + [(1000 + i, "a/b", t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = {r.doc_id: r.own_license for r in licenses.own_licenses(frame, "doc_id", "path", "text").collect()}
    assert [(i, cases[i][1][:40], found[i]) for i in range(len(cases))] == [(i, t[:40], name) for i, (name, t) in enumerate(cases)]


def test_notices_beside_other_words(spark):
    """At many documents, words beside a notice neither hide it nor weigh more than their frequency."""
    cases = [
        ("MIT", "This project is released under the MIT License."),
        ("MIT", "All code here is released under the MIT License."),
        ("Apache-2.0", "Copyright 2021 Example Authors. Licensed under the Apache License, Version 2.0."),
        ("MIT", "Project code here. Released under the MIT License. Other words follow on the same line, and many more of them than the notice has."),
        (None, "All code of this project is released under the license that comes with it."),
    ]
    vocabulary = {w: 3000 for _, t in (*licenses.TEMPLATES, *licenses.TITLES) for w in licenses.words_of(t)}
    matcher = licenses.Matcher(licenses.TEMPLATES, 3_000_000, vocabulary, licenses.MIN_COSINE, licenses.TITLES)
    assert [matcher.best(t)[0] for _, t in cases] == [name for name, _ in cases]
    rows = [(i, "a/b", t) for i, (_, t) in enumerate(cases)] + [(100 + i, "a/b", f"some other project code here words {i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(3)
    found = {r.doc_id: r.own_license for r in licenses.own_licenses(frame, "doc_id", "path", "text").collect()}
    assert [found[i] for i in range(len(cases))] == [name for name, _ in cases] and len(found) == len(rows)
    counts = {r.word: r.n for r in licenses.word_counts(frame).collect()}
    assert counts["project"] == 203 and counts["mit"] == 3 and counts["code"] == 203
