"""Licence scan: wrapped notices, notices without anchor words, unknown sentences and edge cases."""

import textwrap

import pytest

from quire.llm import licenses
from quire.llm.queries import QUERIES

CASES = [
    ("plain words about nothing at all", "", 0, 0),
    ("Released under GPLv3", "gpl-3.0", 1, 0),
    ("Dual MIT/Apache-2.0", "apache-2.0,mit", 2, 0),
    ("CC BY-NC 4.0", "cc-by-nc", 1, 0),
    ("distributed under the MIT terms", "mit", 1, 0),
    *((textwrap.fill(licenses.TEMPLATES[f][1], 60), f, 1, 0) for f in ("gpl-3.0", "gpl-2.0")),
    *(("intro\n#\n" + textwrap.indent(textwrap.fill(licenses.TEMPLATES[f][1], 60), "# ") + "\n#\nimport x", f, 1, 0) for f in ("gpl-3.0", "gpl-2.0")),
    ("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", "apache-2.0,mit", 2, 0),
    ("Released under the MIT License.\n\nReleased under the MIT License.", "mit", 2, 0),
    ("so it goes " * 400 + "Released under the MIT License. " + "and on " * 400, "mit", 1, 0),
    ("Please renew your driver's license before it expires.", "", 0, 1),
    ("Students at MIT need no parking license.", "", 0, 1),
    ("one\n\nAll rights reserved. Copyright 2019 by the author.\n\ntwo", "", 0, 1),
    (None, "", 0, 0), ("", "", 0, 0), ("\n\n", "", 0, 0),
]


def test_planted_cases(spark):
    rows = [(None if k % 5 == 4 else k // 2, c[0], "clash") for k, c in enumerate(CASES)] + [(77, CASES[1][0], "clash")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string").repartition(3)
    got = sorted(map(tuple, licenses.license_scan(docs).collect()), key=repr)
    want = [(r[0], *c[1:]) for r, c in zip(rows, [*CASES, CASES[1], CASES[1]])]
    assert sorted(set(got) ^ set(want), key=repr) == [] and got == sorted(want, key=repr)


@pytest.fixture(scope="module")
def classifier(spark):
    return licenses.train(spark)


def scan(spark, classifier, texts):
    rows = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), classifier).collect()
    return [(r.families, r.n_licenses, r.n_unknown) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_every_template_is_found(spark, classifier):
    cases = [(t, f) for f, ts in licenses.TEMPLATES.items() for t in ts]
    inside = [f"some words before it\n\n{t}\n\nand some behind" for t, _ in cases]
    assert scan(spark, classifier, [t for t, _ in cases] + inside) == [(f, 1, 0) for _, f in cases] * 2


def test_ordinary_prose_is_left_alone(spark, classifier):
    prose = [
        "Wir gehen mit dem Hund in den Wald. Das ist mit ihm immer schön.", "Mit freundlichen Grüßen, mit Dank", "He went to school at MIT under the old terms.",
        "The apache helicopter landed.", "Software of this kind is found in the public library, version two, free of charge.",
    ]
    assert scan(spark, classifier, prose) == [("", 0, 0)] * len(prose)


def test_query_against_a_plain_search(spark):
    # the notices that the table holds, found by plain comparison of lines
    known = {t.lower(): f for f, ts in licenses.TEMPLATES.items() for t in ts}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        found = [known[line.strip().lower()] for line in (r.text or "").split("\n") if line.strip().lower() in known]
        want[r.doc_id] = ",".join(sorted(set(found)))
    got = QUERIES["op2_license_scans"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.families for r in got} == want and len(got) == len(docs)
    assert sum(map(bool, want.values())) > 30 and sum(r.n_unknown for r in got) <= 2
    # the same for any part of the table: no document's result depends on others
    some = spark.createDataFrame([(r.doc_id, r.text) for r in docs if r.doc_id % 50 == 0 or want[r.doc_id]], "doc_id long, text string")
    assert {r.doc_id: (r.families, r.n_unknown) for r in licenses.license_scan(some).collect()} == {
        r.doc_id: (r.families, r.n_unknown) for r in got if r.doc_id % 50 == 0 or want[r.doc_id]
    }


def test_empty_table(spark):
    assert licenses.license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
