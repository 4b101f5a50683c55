"""Recall of the licence scan on notices worded as projects print them, not as the templates are."""

import numpy as np

from triagelake.llm import licences

PRINTED = {
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Except where noted, this work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License (CC BY-NC 4.0)"],
    "CC-BY-ND-4.0": ["Text licensed under CC BY-ND 4.0", "This work is licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Photos licensed under CC BY-NC-SA 4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-3.0": ["This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License."],
    "GPL-2.0": ["This module is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["This server is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "Licensed under the BSD 2-Clause \"Simplified\" License."],
    "Apache-2.0": [open("/usr/share/common-licenses/Apache-2.0").read()],
    "GPL-3.0": [open("/usr/share/common-licenses/GPL-3").read()],
    "BSD-3-Clause": [open("/usr/share/common-licenses/BSD").read()],
}


def best(spark, texts):
    """The licences (without '-short', '-header' and the like) of highest coefficient, by text number."""
    found = licences.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    top = {}
    for r in found:
        top[r.doc_id] = max(top.get(r.doc_id, (0.0, "")), (r.dice, r.licence))
    return {i: name for i, (_, name) in top.items()}


def test_printed_notices_are_found(spark):
    wanted = [(name, text) for name, texts in PRINTED.items() for text in texts]
    got = best(spark, [f"Some prose of a page.\n{t}\nMore prose." if len(t) < 400 else t for _, t in wanted])
    for i, (name, text) in enumerate(wanted):
        assert got.get(i, "").startswith(name), (name, got.get(i), text[:80])


def test_plain_prose_has_no_licence(spark):
    prose = ["The terms of the agreement and the conditions of the sale are in the contract of the parties, subject to the following.", "She was licensed to drive under the new rules. " * 40]
    assert best(spark, prose) == {}


def test_notices_inside_longer_parts_are_found(spark):
    prose = " ".join(f"word{i} of the story" for i in range(60))
    apache = (
        "/*\n * Copyright 2019 Somebody\n *\n * Reads the tables of the store and {0}.\n *\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance\n"
        " * with the License. You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n *\n * {0}\n */\n{0}"
    ).format(prose)
    texts = [
        apache, apache.replace("\n", "\r\n"), f"{prose}. Released under the MIT License. {prose}", f"{prose} (licensed under CC BY-NC-ND 4.0) {prose}",
        f"{prose}\n{open('/usr/share/common-licenses/GPL-2').read()}\n{prose}\n{prose}",
    ]
    got = best(spark, texts)
    for i, name in enumerate(("Apache-2.0", "Apache-2.0", "MIT", "CC-BY-NC-ND-4.0", "GPL-2.0")):
        assert got.get(i, "").startswith(name), (name, got.get(i))


def test_best_window_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        grams = rng.integers(0, 9, rng.integers(1, 40)).astype(np.uint64)
        notice, length = set(rng.integers(0, 9, 5).tolist()), int(rng.integers(1, 12))
        runs = [set(grams[i : i + length].tolist()) for i in range(len(grams) - length + 1)] if len(grams) > length else []
        wanted = max((2 * len(r & notice) / (len(r) + len(notice)) for r in runs), default=0.0)
        fewest = int(np.ceil(0.6 * len(notice)))
        got = licences._best_window(grams, licences._before(grams), np.isin(grams, list(notice)), length, len(notice), fewest)
        assert got == wanted or wanted < 0.75 and got in (0.0, wanted)


def test_header_over_lines_of_a_comment_is_found(spark):
    prose = " ".join(f"word{i} of the story" for i in range(60))
    text = (
        f"/*\n * {prose}\n *\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance\n"
        f" * with the License. You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n *\n * {prose}\n */"
    )
    found = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).where("licence = 'Apache-2.0-header'").collect()
    assert len(found) == 1 and found[0].dice > 0.95 and found[0].n_parts == 0


def family(name):
    for end in ("-full", "-short", "-header", "-notice", "-text", "-long"):
        name = name.removesuffix(end)
    return name


def test_one_licence_per_printed_notice(spark):
    """All rows count: siblings that differ in a word are not named beside the printed licence."""
    wanted = [(name, text) for name, texts in PRINTED.items() for text in texts if len(text) < 600]
    rows = [(i, f"Some prose of a page.\n{t}\nMore prose.") for i, (_, t) in enumerate(wanted)]
    got = {}
    for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.licence)
    for i, (name, text) in enumerate(wanted):
        assert got.get(i) and all(x.startswith(name) and not x[len(name) :].startswith("-4.0") for x in got[i]) or {family(x) for x in got[i]} == {name}, (name, got.get(i), text[:80])


def test_two_notices_apart_are_both_named(spark):
    prose = " ".join(f"word{i} of the story" for i in range(40))
    text = f"Licensed under CC BY-NC 4.0.\n{prose}\nReleased under the MIT License."
    got = {r.licence for r in licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert any(x.startswith("CC-BY-NC-4.0") for x in got) and any(x.startswith("MIT") for x in got) and len({family(x) for x in got}) == 2


def test_peaks_and_standing_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(100):
        scores, reach = rng.integers(0, 6, rng.integers(1, 30)) / 5, int(rng.integers(0, 6))
        want = [i for i, v in enumerate(scores) if v >= 0.6 and v >= scores[max(0, i - reach) : i + reach + 1].max()]
        assert licences._peaks(scores, 0.6, reach).tolist() == want
        spans = [(int(s), int(s + n), int(v) / 4) for s, n, v in zip(rng.integers(0, 50, 12), rng.integers(1, 20, 12), rng.integers(0, 5, 12))]
        stands = [not any(o[2] > m[2] and 2 * (min(o[1], m[1]) - max(o[0], m[0])) > min(o[1] - o[0], m[1] - m[0]) for o in spans) for m in spans]
        assert licences.standing(spans).tolist() == stands
    assert licences.standing([]).tolist() == []
