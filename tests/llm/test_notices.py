"""A license's naming word is needed."""

from rollbook.llm import licenses

TEXTS = {
    "This work is licensed under the GNU General Public License version 3": "gpl",
    "GNU General Public License": "gpl",
    "the GNU Lesser General Public License": "gpl,lgpl",
    "released under the BSD license": "",
    "released under the MIT license": "mit",
    "Released under MIT License": "mit",
    "available under the MIT license": "mit",
    "Licensed under the Educational Community License, Version 2.0": "",
    "Licensed under the Apache License, Version 2.0": "apache",
    "Licensed under the Apache License, Version 2": "apache",
    "subject to the terms of the Eclipse Public License": "",
    "subject to the terms of the Mozilla Public License": "mpl",
    "This work is dedicated to the public domain under law": "",
    "This software is dedicated to the public domain under CC0": "cc0",
}


def test_notices_need_the_name(spark):
    found = licenses.scan(spark.createDataFrame([(t, t) for t in TEXTS], "doc_id string, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in found} == TEXTS
    assert all(r["score"] == 0.0 for r in found if not r["labels"])
