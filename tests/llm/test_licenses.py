"""Every kind of licence line in the tables, short forms, and notices wrapped over lines."""

import re

import pytest

from haulgrid.llm import licenses

SF = "/root/testdata/sf0.01"
PLANTED = {
    "All rights reserved.": "Proprietary",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
}
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return licenses.fit_licenses(docs)


def test_all_planted_lines_are_found_and_nothing_else(spark, docs):
    wanted = {
        r.doc_id: [PLANTED[line] for line in r.text.split("\n") if line in PLANTED]
        for r in docs.where("text is not null").collect()
    }
    found = {r.doc_id: [x.family for x in r.licenses] for r in licenses.license_scan(docs).collect() if r.text is not None}
    assert found == wanted and {f for families in found.values() for f in families} == set(PLANTED.values())


@pytest.mark.parametrize("family,text", [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts])
def test_each_template_is_found_as_itself(model, family, text):
    assert model.classify(text)[0] == family
    words = text.split()
    if len(words) >= 8:  # wrapped in the middle
        half = len(words) // 2
        wrapped = " ".join(words[:half]) + "\n" + " ".join(words[half:])
        assert {row[1] for row in model.scan(wrapped)} == {family}


@pytest.mark.parametrize("family,notice", [("MIT", MIT), ("BSD", BSD)])
def test_wrapped_notices(model, family, notice):
    text = f"A title\n\nsome other words here\n{notice}\nand it goes on here\n\nthe end"
    (place, found, probability, paragraph), = model.scan(text)
    assert found == family and probability >= 0.5 and place == 2
    assert notice.split("\n")[0] in paragraph and paragraph in notice


def test_words_apart_are_no_notice(model):
    assert model.scan("all of us have rights\nand seats are reserved\nfor all") == []
    assert model.classify("All seats are reserved and the rights are ours")[0] == "unknown"
    assert model.scan(None) == model.scan("") == model.scan("\n \n***\n") == []
    assert not re.search("licen", "\n".join(row[3] for row in model.scan("word " * 5000 + "\n" + "other " * 5000)))
