"""Digests of long files by blocks."""

import hashlib

from mercato.sources import tree_digest


def by_hand(text, block):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = text.split("\n")[:-1] if text.endswith("\n") else text.split("\n")
    leaves = [sha(x) for x in lines]
    return len(lines), sha("".join(sha("".join(leaves[i:i + block])) for i in range(0, len(leaves), block)))


def test_split_files_have_the_digest_of_their_lines(spark, tmp_path):
    texts = {"a": "".join(f"line {i} {'é' * (i % 9)}\n" for i in range(700)), "b": "one", "c": "x\r\ny\n\nz\n", "d": "same\n" * 300}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        assert tree_digest.numbered_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 1
        got = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["digest"]) for r in tree_digest.file_digests(spark, str(tmp_path), 64).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {name: by_hand(text, 64) for name, text in texts.items()}


def test_status_of_every_file(spark):
    rows = lambda spec: spark.createDataFrame([(f, n, v) for f, vs in spec.items() for n, v in enumerate(vs)], "file string, number bigint, value string")
    listed = tree_digest.digests(rows({"same": ["a", "b"], "swapped": ["a", "b"], "cut": ["a", "b"], "gone": ["a"]}), 1)
    found = tree_digest.digests(rows({"same": ["a", "b"], "swapped": ["b", "a"], "cut": ["a"], "new": ["a"]}), 1)
    got = {r["file"]: r["status"] for r in tree_digest.compared(found, listed).collect()}
    assert got == {"same": "ok", "swapped": "changed", "cut": "changed", "gone": "missing", "new": "unlisted"}
