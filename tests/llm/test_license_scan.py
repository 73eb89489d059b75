import pytest

from clickfeat.llm import common, license_scan
from conftest import SF_CHECK
from util import edge_rows, frame

LINES = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC",
         "This work is licensed under the GNU General Public License, version 3.": "GPL", "All rights reserved.": "proprietary"}


@pytest.fixture(scope="module")
def scanned(spark):
    docs = common.documents(spark, SF_CHECK)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()[:150]
    rows = [(r.doc_id, r.text) for r in plain]
    rows += [(r[0] if r[0] is None else r[0] + 5000, *r[1:]) for r in edge_rows()]
    more = [
        (20_000, "intro\n" + license_scan.NOTICES["BSD"][3] + "\nmore"), (20_001, "Redistribution and use in source and binary form, with or without modification, are permitted if the following conditions are met"),
        (20_002, "word " * 300 + "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. " + "word " * 300),
        (20_003, "My fishing license was revoked and the warranty of the boat ended."), (20_004, "He had permission to copy the general's public letters."),
        (20_005, "Released under the MIT License.\nAll rights reserved."),
        (20_006, "released UNDER   the mit license"), (20_006, "released UNDER   the mit license"),
    ]
    rows += more
    return {r[0]: r[1] for r in rows}, license_scan.scan(frame(spark, rows)).collect(), rows


def test_one_row_per_document(scanned):
    _, out, rows = scanned
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((r[0] is None, r[0] or 0) for r in rows)


def test_planted_lines_and_clean_documents(scanned):
    text, out, _ = scanned
    for r in out:
        if r.doc_id is None or r.doc_id >= 20_000:
            continue
        want = {f for line, f in LINES.items() if line in (text[r.doc_id] or "").split("\n")}
        assert set(filter(None, r.families.split(","))) == want, (r, text[r.doc_id][-200:])


def test_variants(scanned):
    _, out, _ = scanned
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[20_000][0].family == by[20_001][0].family == "BSD"
    assert by[20_002][0].family == "Apache-2.0"
    assert by[20_003][0].family == by[20_004][0].family == "none" and by[20_003][0].score == 0
    assert by[20_005][0].families == "MIT,proprietary" and by[20_005][0].n_paragraphs == 2
    assert [r.family for r in by[20_006]] == ["MIT", "MIT"]


def test_empty(spark):
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_abbreviated_hyphenated_and_wrapped_notices(spark):
    mit, apache = license_scan.NOTICES["MIT"][3], license_scan.NOTICES["Apache-2.0"][4]

    def wrap(text, n):
        w = text.split()
        return "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    want = {"Released under the LGPL version 3 or later.": "LGPL", "Released under CC-BY-SA 4.0.": "CC", "This file is available under Apache 2.0.": "Apache-2.0",
            "a story\n\n" + wrap(mit, 3) + "\n\nthe end": "MIT", wrap(apache, 4): "Apache-2.0", "Some words first.\nReleased under\nthe MIT License.": "MIT",
            "Released\n\nunder\n\nMIT": "", "The cat sat on the mat.\nOf the\nto the\nof this file": ""}
    rows = [(i, t) for i, t in enumerate(want)]
    docs = common.documents(spark, SF_CHECK).select("doc_id", "text").limit(100).collect()
    out = {r.doc_id: r for r in license_scan.scan(frame(spark, rows + [(1000 + r.doc_id, r.text) for r in docs])).collect()}
    for (i, t), f in zip(rows, want.values()):
        assert out[i].families == f, (t, out[i])
    lines = [(1, "Released under the MIT License."), (2, "Released under the AGPL, version 3.\nno more"), (3, "Released\nunder the MIT License."), (4, "The boat was under the\nbridge.")]
    got = {(r.doc_id, r.line, r.last) for r in license_scan.paragraphs(frame(spark, lines)).collect()}
    assert {(1, 0, 0), (2, 0, 0), (3, 0, 1)} <= got
