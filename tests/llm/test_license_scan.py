import re

import pytest

from orderweir.llm import license_scan
from tests_llm_help import none, odd, prose  # noqa: F401

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction."
)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    own, found = words(text), []
    for phrase, label in license_scan.BASE.items():
        body = phrase.split()
        found += [(label, i) for i in range(len(own) - len(body) + 1) if own[i : i + len(body)] == body]
    return len(own), sorted(found)


@pytest.fixture(scope="module")
def scanned(spark):
    texts = [
        "Released under the MIT License.", "under the\nMIT-license; under THE mit license", "cc by nc cc-by-nc 4.0",
        "Licensed under the Apache License, Version 2.0.", prose(1) + " " + MIT + " " + prose(2), MIT.replace("free of charge", "for money"),
        "This work is licensed under the GNU General Public License, version 3.", None, "", "été under the mit license ß",
        prose(3, 20_000) + " CC BY NC", "Licence: Apache License Version 20", "cc", "by nc", *[prose(i) for i in range(10, 40)],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return texts, {r["doc_id"]: r for r in license_scan.find_licences(docs).collect()}


def test_base_phrases_equal_brute_force(scanned):
    texts, got = scanned
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n, spans = brute(text)
        assert (got[i]["n_words"], [(s["label"], s["start"]) for s in got[i]["base"]]) == (n, spans)


def test_passages_need_their_key_phrases(scanned):
    _, got = scanned
    labels = {i: [s["label"] for s in r["found"]] for i, r in got.items()}
    assert labels[4] == ["mit"] and got[4]["found"][0]["score"] > 0.9 and got[4]["found"][0]["start"] == 40
    assert labels[5] == [] and labels[6] == ["gpl-3"]
    assert all(not labels[i] for i in range(14, len(labels)))


def test_odd_rows(odd, none):  # noqa: F811
    rows = license_scan.find_licences(odd).collect()
    assert len(rows) == odd.count() and all(r["base"] == [] and r["found"] == [] for r in rows)
    assert license_scan.find_licences(none).count() == 0


def test_canonical_texts_and_headers_get_their_label(spark):
    two = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n{} Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.\n{} Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.\n"
    )
    three = (
        "{} Neither the name of the {} nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.\n"
    )
    gnu = (
        "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation{} either version {} of the License, or (at your option) any later version.\n"
    )
    cases = [
        (two.format("1.", "2.") + three.format("3.", "copyright holder"), "bsd-3-clause"),
        (two.format("*", "*") + three.format("*", "University of California, Berkeley"), "bsd-3-clause"),
        (two.format("1.", "2."), "bsd-2-clause"),
        (gnu.format(";", "General Public License", ";", 2), "gpl-2"),
        (gnu.format(":", "General Public License", ",", 3), "gpl-3"),
        (gnu.format(":", "Lesser General Public License", ",", 3), "lgpl-3"),
        (gnu.format(":", "Affero General Public License", ",", 3), "agpl-3"),
        (MIT, "mit"),
    ]
    rows = [(i, f"{prose(i)}\n{text}{prose(50 + i)}") for i, (text, _) in enumerate(cases)]
    rows += [(100 + i, prose(200 + i)) for i in range(20)]
    got = license_scan.find_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    labels = {r["doc_id"]: [s["label"] for s in r["found"]] for r in got}
    assert [labels[i] for i in range(len(cases))] == [[label] for _, label in cases]
    assert all(labels[100 + i] == [] for i in range(20))
