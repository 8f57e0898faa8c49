import re

import pytest

from ledgerloom.llm import license_scan as ls
from tests.llm.data import empty, frame, messy

EXTRA = [
    (600, "Licensed under CC BY-NC 4.0. all Rights reserved, all rights  reserved", "en", "a"),
    (601, "the GNU general public license; General\nPublic\tLicense and cc by and CC-BY", "en", "a"),
    (602, "Licensed under the big Apache License, Version 2.0.", "en", None),
    (603, "rights reserved all", "en", "a"), (604, "cc by " * 5000, "en", "a"), (605, "Released under the MIT License.", "en", "a"),
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    places = [(i, label) for p, label in ls.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_matches_brute_force_and_method_adds_labels(spark):
    rows = messy() + EXTRA
    got = ls.scan(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=str) == \
        sorted([(i, *brute(t)) for i, t, *_ in rows], key=str)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[602] == "apache-2.0" and labels[605] == "mit" and labels[603] == ""     # 602: one word was put in
    assert labels[600] == "cc-by,cc-by-nc,reserved" and labels[601].split(",")[:2] == ["cc-by", "gpl"]
    for r in got:
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def labels_of(spark, texts, templates=None):
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    return [r.labels for r in sorted(ls.scan(frame(spark, rows), templates=templates).collect(), key=lambda r: r.doc_id)]


def test_usual_wordings_and_names(spark):
    texts = ["Licensed under the terms of the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: MIT",
             "licensed under the terms of the Mozilla License, version 2.0", "subject to the terms of the Eclipse Public License, version 2.0",
             "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
             "Licensed under the terms of the big Apache License, Version 2.0", "licensed under the BSD license"]
    assert labels_of(spark, texts) == ["apache-2.0", "gpl-3.0", "mit", "", "epl", "gpl,gpl-2.0", "apache-2.0", ""]


def test_templates_of_the_caller_of_any_length(spark):
    body = " ".join(f"clause{i} of" for i in range(100))             # 200 words: four sections
    texts = ["x " + body + " y", " ".join(body.split()[50:100]), " ".join(body.split()[:20]), "released under the mit license", "cc by " + body.upper()]
    assert labels_of(spark, texts, {body: "house"}) == ["house", "house", "", "", "cc-by,house"]
    assert all(len(s) <= ls.SECTION for s in ls.sections(body)) and sum(ls.sections(body), []) == body.split()
    for n in (64, 65, 66):
        phrase = " ".join(f"w{i}" for i in range(n))
        assert labels_of(spark, [phrase, phrase.replace("w3 ", "z ")], {phrase: "p"}) == ["p", "p"]
    with pytest.raises(ValueError, match="needs 2 words"):
        ls.template_table(spark, {"word": "x"})


def test_empty_table(spark):
    assert ls.scan(empty(spark)).collect() == []
