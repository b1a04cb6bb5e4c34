import re

import pytest

from shelfrank.llm import licenses
from tests.llm.frames import frame, lower, odd_rows, prose

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places, labels = [], set()
    for phrase, label in BASE.items():
        own = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        labels |= {label} if found else set()
    places.sort()
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None, ",".join(sorted(labels)))


def rows():
    mit = "Released under the MIT License."
    return odd_rows() + [
        (100, mit),
        (101, prose(1, 20) + "\n" + mit + " " + mit),
        (102, "The Apache-License and the MIT  LICENSE, mit license"),
        (103, "Licensed under the Apache License, Version 2.0. " + prose(2, 4000)),
        (104, "This work is licensed under the GNU General Public License, version 3."),
        (105, "general public licenses; general public\nlicense"),
        (106, "licensed under CC BY-NC 4.0"),
        (107, "license"),
        (108, "MİT License apache lıcense"),
        (109, "some license by nc 4 under"),
        (110, "permission is hereby granted, free of charge, to any person obtaining a copy of this software and"),
        (100, mit),
    ]


def test_places_match_brute_force(spark):
    data = rows()
    got = licenses.scan_licenses(frame(spark, data).coalesce(1)).collect()
    want = sorted(str((r[0], *brute(r[1]))) for r in data)
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
        assert (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize(
    ("doc_id", "labels"),
    [(100, "mit"), (103, "apache,apache-2.0"), (104, "gpl,gpl-3.0"), (106, "cc-by-nc-4.0"), (109, ""), (110, "mit"), (107, "")],
)
def test_templates_add_labels(spark, doc_id, labels):
    got = licenses.scan_licenses(frame(spark, rows())).where(f"doc_id = {doc_id}").first()
    assert got.labels == labels


def test_empty_table(spark):
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
