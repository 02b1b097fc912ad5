"""Licence digests: spellings, copyright lines, notices."""

from sensorloom.llm import licences
from tests.llm.conftest import documents


def test_scan(spark):
    mit = next(t for i, t in licences.LICENCES if i == "MIT")
    british = mit.replace("sublicense", "sub-licence").upper()
    bsd = next(t for i, t in licences.LICENCES if i == "BSD-3-Clause")
    rows = [
        (1, mit),
        (2, f"Copyright (c) 2020 Some Body\n\n  (C) another\n{british}\nAll rights reserved."),
        (3, f"# {bsd.replace(' ', chr(9) + ' ')}"),
        (4, f"{mit} and one word more"),
        (5, "Some prose.\nReleased under the MIT licence!\nlicensed under the apache licence version 2 0\nReleased under the MIT License."),
        (6, None),
        (7, ""),
        (8, "Copyright 2020 X"),
        (None, "Licensed under CC BY 4.0."),
        (1, mit),
        (9, "word " * 100_000 + "\n" + "Licensed under CC BY-NC 4.0."),
    ]
    got = {(r.doc_id, r.license_id, r.notices, r.n_notices) for r in licences.scan(documents(spark, rows)).collect()}
    assert got == {
        (1, "MIT", "", 0),
        (2, "MIT", "", 0),
        (3, "BSD-3-Clause", "", 0),
        (4, None, "", 0),
        (5, None, "Apache-2.0,MIT", 2),
        (6, None, "", 0),
        (7, None, "", 0),
        (8, None, "", 0),
        (None, "CC-BY-4.0", "CC-BY-4.0", 1),
        (9, None, "CC-BY-NC-4.0", 1),
    }
    assert licences.scan(documents(spark, rows)).count() == len(rows)
    assert licences.scan(documents(spark, [])).count() == 0


def test_known_digests_are_unambiguous(spark):
    known = licences.known(spark).collect()
    assert len({r.digest for r in known}) == len(known)
