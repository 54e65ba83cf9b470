"""Whole copies under usual headers, wrapped anew, with other holders; and the SQL over the same rows."""

import textwrap

import duckdb
import pytest

from cratewise.llm import licenses, sql

MIT = licenses.LICENSES["MIT"].split("\n", 2)[2]
BSD2 = licenses.LICENSES["BSD-2-Clause"]


def bsd3(mark, holder):
    text = dict(licenses.catalogue())["BSD-3-Clause"].split("\n\n", 1)[1]
    for number in "123":
        text = text.replace(f"{number}. ", mark)
    return text.replace("the University nor", f"{holder} nor").replace("THE REGENTS AND", f"{holder.upper()} AND").replace("THE REGENTS OR", f"{holder.upper()} OR")


HEADED = {
    "title in brackets": ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2015 Ann Other\n\n" + MIT),
    "holder without a sign": ("MIT", "Copyright Joyent, Inc. and other contributors. All rights reserved.\n" + MIT),
    "notice before the title": ("MIT", "Copyright (c) 2020 Somebody\n\nMIT License\n\n" + MIT),
    "placeholders": ("MIT", "Copyright <YEAR> <COPYRIGHT HOLDER>\n\n" + MIT),
    "sign before the year": ("MIT", "© 2019 Somebody\r\n\r\n" + MIT.replace("\n", "\r\n")),
    "no header": ("MIT", MIT),
    "numbers in brackets": ("BSD-2-Clause", 'BSD 2-Clause "Simplified" License\n\n' + BSD2.replace("1. ", "(1) ").replace("2. ", "(2) ")),
    "stars": ("BSD-3-Clause", "Copyright (c) 2001-2011, The Example Team\n\n" + bsd3("  * ", "the Example Team")),
    "long holder": ("BSD-3-Clause", "BSD 3-Clause License\n\n" + bsd3("- ", "Example Widgets and Sons, Inc. of Springfield")),
    "older ISC": ("ISC", "ISC License\n\nCopyright 2004 ISC\n\n" + licenses.LICENSES["ISC"].replace("and/or", "and").replace("THE AUTHOR", "ISC")),
    "with a change": (None, MIT.replace("without restriction", "without any restriction")),
    "held in a text": (None, "My words come first.\n" + MIT),
    "no text": (None, None),
    "notices only": (None, "Copyright (c) 2020 Somebody\nAll rights reserved."),
    "clause four added": (None, bsd3("* ", "the Example Team") + "\n4. One more clause."),
}


def wrapped(text, width):
    parts = [p if p.lstrip().lower().startswith("copyright") or len(p) < 20 else textwrap.fill(p, width) for p in text.split("\n")]
    return "\n".join(parts)


@pytest.fixture(scope="module")
def rows():
    out = [(f"{name}", want, text) for name, (want, text) in HEADED.items()]
    for number, (name, text) in enumerate(licenses.catalogue()):
        out.append((f"{name} {number}", name, text))
        if name != "MPL-1.1":  # a sentence of its exhibit has "Copyright (C)" where the wrap starts a line
            out.append((f"{name} {number} wrapped", name, wrapped(text, 54)))
        out.append((f"{name} {number} upper", name, text.upper().replace("\n\n", "\n \n\n")))
    return out


def test_whole_copies(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, _, t in rows], "doc_id string, text string, known string")
    found = {r["doc_id"]: r for r in licenses.scanned(docs.drop("known"), licenses.known_digests(spark)).collect()}
    assert {i: found[i]["license"] for i, _, _ in rows} == {i: want for i, want, _ in rows}


def test_sql_agrees(spark, rows):
    found = licenses.scanned(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id string, text string"), licenses.known_digests(spark))
    engine = duckdb.connect()
    engine.execute("CREATE TABLE documents (doc_id VARCHAR, text VARCHAR)")
    engine.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, _, t in rows])
    expected = engine.sql(sql.license_scan()).fetchall()
    assert sorted((r["doc_id"], r["digest"], r["license"]) for r in found.select("doc_id", "digest", "license").collect()) == sorted(expected)


def test_no_text_stands_for_two_licences(spark):
    table = spark.createDataFrame(licenses.catalogue(), "license string, text string").select("license", licenses.digest().alias("digest"))
    assert table.groupBy("digest").agg({"license": "min"}).count() == table.distinct().count()
