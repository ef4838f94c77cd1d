"""Small documents with every odd case, and a helper to make frames of them."""

import random

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
# Names that operators use inside.
CLASHING = ("row", "digest", "heavy", "rank", "fp", "w", "place", "size", "target", "taken", "key", "site", "lines", "row_hash", "raw", "word", "score", "id", "doc", "keep", "copies")


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def doc(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def odd_rows():
    base = "The quick brown fox jumps over the lazy dog and then it sleeps for a while under the old tree."
    return [
        doc(1, base), doc(2, base.upper()), doc(3, None), doc(4, ""), doc(5, " \t\n "), doc(None, base), doc(None, None, None),
        doc(7, "é É ß K"), doc(7, "é É ß K"), doc(7, "another text under the same id"), doc(8, LONG, "b"), doc(9, LONG.upper(), None, None),
        doc(10, "x"), doc(11, "one\n\ntwo\none"), doc(12, base + "\n" + base, None), doc(-3, "Licensed under CC BY-NC 4.0.", "c"),
    ]


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def prose(n, seed=5, vocabulary=400, sources=6):
    """Random documents with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgéß", k=rng.randint(2, 7))) for _ in range(vocabulary)]
    passage = " ".join(rng.choices(words, k=60))
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.15:
            text = rng.choice(rows)[1]
            text = text if rng.random() < 0.5 else text.upper().replace("É", "é").replace("SS", "ß")
        elif rows and kind < 0.3:
            parts = rng.choice(rows)[1].split(" ")
            parts[rng.randrange(len(parts))] = rng.choice(words)
            text = " ".join(parts)
        else:
            text = " ".join(rng.choices(words, k=rng.randint(1, 200)))
            if kind > 0.85:
                text = f"{text} {passage} {rng.choice(words)}"
        rows.append(doc(i, text, f"s{rng.randrange(sources)}"))
    return rows
