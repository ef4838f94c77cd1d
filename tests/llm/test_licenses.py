import re
import time

import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

from mercato.llm import licenses


def words(text):
    return [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())]


def places(w, phrase):
    p = phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]


TEXTS = [
    "Released under the MIT License.", "UNDER  THE\nmit-license under the mit license", "Licensed under the Apache License, Version 2.0.", "apache license version 2", "Apache License Version 2é",
    "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc", "cc by", "mit license", "All rights reserved.", "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public license version 3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "redistribution and use in source and binary forms of it", "under the K mit license", "x " * 5000 + "under the mit license " + "y " * 5000 + "Licensed under CC BY-NC 4.0. All rights reserved.",
]
ROWS = odd_rows() + [doc(100 + i, t) for i, t in enumerate(TEXTS)] + [doc(101, TEXTS[1])] + prose(40)


def scan(spark, rows):
    return licenses.license_scan(with_clashes(frame(spark, rows)))


def test_base_places_equal_brute_force(spark):
    got = scan(spark, ROWS).collect()
    want = []
    for r in ROWS:
        w = words(r[1])
        found = {label: places(w, phrase) for phrase, label in licenses.PHRASES.items()}
        starts = [x for v in found.values() for x in v]
        want.append((r[0], len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(k for k, v in found.items() if v))))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


@pytest.mark.parametrize("notice", range(len(licenses.NOTICES)))
def test_every_notice_is_found_whole(spark, notice):
    label, text, key = licenses.NOTICES[notice]
    assert f" {key} " in f" {text} "
    if notice % 4 == 0:  # a few through Spark; the rest are covered by the next test
        row = scan(spark, [doc(1, f"Some words before. {text.upper()} and after"), doc(2, "nothing here")]).orderBy("doc_id").collect()
        assert label in row[0].labels.split(",") and row[0].score == 1.0 and row[1].labels == ""


def test_all_notices_in_one_file(spark):
    row = scan(spark, [doc(1, " filler words ".join(n[1] for n in licenses.NOTICES))]).first()
    assert set(row.labels.split(",")) == {n[0] for n in licenses.NOTICES}


def test_key_phrase_is_mandatory(spark):
    got = {r.doc_id: r.labels for r in scan(spark, ROWS).collect()}
    assert got[109] == "all-rights-reserved" and got[110] == "gpl-3" and got[112] == "bsd" and got[113] == "" and got[107] == "" and got[104] == ""
    assert got[115] == "all-rights-reserved,cc-by-nc,mit"


def test_labels_and_scores_equal_a_direct_comparison(spark):
    rows = ROWS + [doc(900 + i, t) for i, t in enumerate([
        "GNU GENERAL PUBLIC LICENSE Version 2", "GNU LESSER GENERAL PUBLIC LICENSE", "SPDX-License-Identifier: GPL-3.0-only", "Eclipse Public License - v 2.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "Permission is hereby granted, free of charge, to any person",
        "all rights", "Redistribution and use in source and binary forms, with or without changes to it all, are permitted provided"])]
    rows.append(doc(950, licenses.NOTICES[12][1]))
    got = {(r.doc_id, r.n_words): (r.labels, round(r.score, 9)) for r in scan(spark, rows).collect()}
    for r in rows:
        w, found = words(r[1]), []
        for _, label, _, text, key_at, key in licenses.templates():
            for at in places(w, " ".join(key)):
                share = sum(0 <= at - key_at + i < len(w) and w[at - key_at + i] == x for i, x in enumerate(text)) / len(text)
                found += [(label, share)] if share >= licenses.LEAST_SHARE else []
        want = ",".join(sorted({label for label, _ in found})), round(max((share for _, share in found), default=0), 9)
        assert got[(r[0], len(w))] == want, r[:1]
    assert [got[k][0] for k in sorted((k for k in got if k[0] in range(900, 906)))] == ["gpl-2", "lgpl", "gpl-3", "epl-2", "mit", ""]


def test_cut_notice_alone(spark):
    """Words of the notice that no file holds don't hide the rest."""
    row = scan(spark, [doc(1, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software")]).first()
    assert row.labels == "mit" and row.score == 0.8


def test_one_very_long_text_costs_its_length(spark):
    begun = time.monotonic()
    row = scan(spark, [doc(1, "the license of this software " * 100_000 + "under the MIT License")]).first()
    assert time.monotonic() - begun < 60 and row.n_words == 500_004 and row.base_labels == "mit" and row.first_word == 500_000


def test_no_python_on_the_main_path(spark):
    plan = scan(spark, ROWS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty(spark):
    assert licenses.license_scan(spark.createDataFrame([], DOC)).count() == 0
