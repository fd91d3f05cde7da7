"""Licence files of any length: licences behind prefaces and many copyright lines."""

import pytest

from quillmill.llm import licenses

MIT = next(t for x, t in licenses.TEMPLATES if x == "MIT" and len(t) > 800).replace(". ", ".\n\n").replace(", ", ",\n")
BSD = next(t for x, t in licenses.TEMPLATES if x == "BSD-3-Clause" and len(t) > 400).replace(". ", ".\n").replace(", ", ",\n")
COPYRIGHTS = "\n".join(f"Copyright (c) {1950 + i} Person Number{i} and others" for i in range(80))
PREFACE = "\n\n".join(f"This paragraph {i} tells of the project, of its many authors, and of how the parts were put together over the years." for i in range(90))


def found(spark, text):
    """What a licence file with the text gives for itself and a file below it."""
    rows = [(1, "a/LICENSE", text), (2, "a/b/code.py", "x = 1")]
    return {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}


@pytest.mark.parametrize("before", [COPYRIGHTS, PREFACE, COPYRIGHTS + "\n" + PREFACE], ids=["copyrights", "preface", "both"])
@pytest.mark.parametrize(("name", "text"), [("MIT", MIT), ("BSD-3-Clause", BSD)])
def test_licences_behind_other_text(spark, name, text, before):
    assert found(spark, f"{before}\n\n{text}\n") == {1: (name, "file"), 2: (name, "inherited")}
    assert found(spark, f"{text}\n\n{before}\n") == {1: (name, "file"), 2: (name, "inherited")}


def test_files_without_a_licence(spark):
    assert found(spark, PREFACE) == {1: (None, "none"), 2: (None, "none")}
    assert found(spark, None) == {1: (None, "none"), 2: (None, "none")} and found(spark, " \n\n ") == {1: (None, "none"), 2: (None, "none")}
    assert found(spark, "licence\n" * 30_000)[1][1] in ("none", "file")  # a very long text
