"""Licence scans through a positional index of rare words, in DataFrame functions only.

Notices (``NOTICES``) and phrases (``PHRASES``) are templates: word lists with a mandatory
key phrase at a known place. Licence words are weighed by their inverse document frequency
over all documents. The index posts, for each template, the places of the ``ANCHORS``
highest-IDF words of its key phrase, and each file looks up those of its words that are
posted. Words of the key phrase are necessary, so a key phrase with a word that no file
holds stands nowhere and is not posted, and the look-up misses no place.

A hit proposes a start: its place in the file less its place in the template, which may lie
before the file, as where a licence file opens with the key phrase. Hits that agree on a
start are intersected: all posted words must stand there, and then the key phrase, word for
word. A phrase is its own key phrase; a notice counts by the share of all its words that
stand where they should, at least ``LEAST_SHARE``.

The index is a fixed, small table (one row per template and anchor) and is broadcast;
texts never move.

Defined cases: null or wordless texts have no places, labels of "" and a score of 0;
repeated ids or rows each get a row; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import words
from .shared import written

ANCHORS = 2
LEAST_SHARE = 0.6

# Phrase -> label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Fixed values: (label, notice, mandatory key phrase inside it).
NOTICES = [
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the license", "use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "permission is hereby granted free of charge to any person"),
    ("mit", "released under the mit license", "under the mit license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license version 3"),
    ("apache-2", "apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use reproduction and distribution",
     "terms and conditions for use reproduction and distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
     "may be used to endorse or promote products derived from this software"),
    ("epl-2", "eclipse public license v 2 0", "eclipse public license v 2 0"),
    ("gpl-2", "either version 2 of the license or at your option any later version", "either version 2 of the license"),
    ("gpl-2", "gnu general public license version 2 june 1991 copyright c", "gnu general public license version 2 june 1991"),
    ("gpl-3", "either version 3 of the license or at your option any later version", "either version 3 of the license"),
    ("gpl-3", "gnu general public license version 3 29 june 2007 copyright c", "gnu general public license version 3 29 june 2007"),
    ("mpl-2", "mozilla public license version 2 0", "mozilla public license version 2 0"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", "this source code form is subject to the terms"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
]

# Label -> licence identifiers as written behind "SPDX-License-Identifier:".
IDENTIFIERS = {
    "agpl-3": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "apache-2": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "cc-by": ["CC-BY-4.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "cc-by-sa": ["CC-BY-SA-4.0"],
    "cc0": ["CC0-1.0"],
    "epl-2": ["EPL-2.0"],
    "gpl-2": ["GPL-2.0-only", "GPL-2.0-or-later"],
    "gpl-3": ["GPL-3.0-only", "GPL-3.0-or-later"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "mit": ["MIT"],
    "mpl-2": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
}


def templates() -> list[tuple[int, str, bool, list[str], int, list[str]]]:
    """(template, label, is a phrase, words, place of the key phrase, its words)."""
    rows = [(label, True, phrase, phrase) for phrase, label in PHRASES.items()] + [(label, False, notice, key) for label, notice, key in NOTICES]
    for label, names in IDENTIFIERS.items():
        tags = [f"spdx license identifier {name.lower().replace('-', ' ').replace('.', ' ')}" for name in names]
        rows += [(label, False, tag, tag) for tag in tags]
    out = []
    for k, (label, base, text, key) in enumerate(rows):
        before = f" {text} ".partition(f" {key} ")[0]
        out.append((k, label, base, text.split(), len(before.split()), key.split()))
    return out


def document_frequency(tokens: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each licence word occurs; one row per word of the fixed vocabulary."""
    held = tokens.select(F.explode(F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), F.col("w"))).alias("word"))
    return {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def postings(docs_with: dict[str, int]) -> list[tuple]:
    """(word, template, label, base, place, size, words, key place, key, anchors): the highest-IDF words of each key phrase that can stand somewhere."""
    out = []
    for k, label, base, text, key_at, key in templates():
        if all(docs_with.get(w) for w in key):
            rarest = sorted(set(key), key=lambda w: (docs_with[w], w))[:ANCHORS]
            out += [(w, k, label, base, key_at + at, len(text), text, key_at, key, len(rarest)) for at, w in enumerate(key) if w in rarest]
    return out


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    tokens = docs.select("doc_id", words().alias("w"))
    vocabulary = sorted({w for t in templates() for w in t[3]})
    index = docs.sparkSession.createDataFrame(
        [("", -1, "", False, 0, 0, [], 0, [], 0), *postings(document_frequency(tokens, vocabulary))],  # "" brings the document's own row
        "word string, template int, label string, base boolean, at int, size int, text array<string>, key_at int, key array<string>, anchors int")
    laid = tokens.withColumn("n_words", F.size("w").cast("bigint")).withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "n_words", "w", F.posexplode(F.concat(F.array(F.lit("")), F.col("w"))).alias("place", "word"))
    hits = laid.join(F.broadcast(index), "word").withColumn("start", F.col("place") - 1 - F.col("at"))
    # The words where the template would lie; null where it begins before the file.
    inside = F.when(F.col("template") >= 0, F.expr("concat(array_repeat(cast(null as string), -start), slice(w, greatest(start, 0) + 1, size + least(start, 0)))"))
    hits = written(hits.select("row", "doc_id", "n_words", "word", "template", "label", "base", "start", "size", "text", "key_at", "key", "anchors", inside.alias("there")), "licence-words")

    found = hits.filter("template >= 0 and slice(there, key_at + 1, size(key)) = key")
    agreed = found.groupBy("row", "template", "start").agg(
        F.countDistinct("word").alias("agree"), F.first("label").alias("label"), F.first("base").alias("base"), F.first("anchors").alias("anchors"),
        F.first(F.expr("size(filter(zip_with(there, text, (a, b) -> a <=> b), same -> same)) / size")).alias("share"))
    standing = agreed.filter((F.col("agree") == F.col("anchors")) & (F.col("share") >= LEAST_SHARE))
    per_row = standing.groupBy("row").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    own = hits.filter("template < 0").select("row", "doc_id", "n_words")
    return own.join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), F.col("first_word").cast("bigint"), F.col("last_word").cast("bigint"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
