import hashlib
from collections import defaultdict

import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes
from pyspark.sql import functions as F

from mercato.llm import exact_dedup


def lower(text):
    return (text or "").encode().lower()


def by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    best = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], best[lower(r[1])], len(groups[lower(r[1])]), hashlib.sha256(lower(r[1])).hexdigest()) for r in rows), key=repr)


@pytest.mark.parametrize("counters", [2, 1024])
@pytest.mark.parametrize("rows", [odd_rows(), prose(300), [doc(i, "Same") for i in range(200)] + prose(100)], ids=["odd", "prose", "hot"])
def test_groups_equal_brute_force(spark, rows, counters):
    got = exact_dedup.copy_groups(with_clashes(frame(spark, rows)).repartition(4), counters).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == by_hand(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_summaries_name_every_heavy_digest(spark):
    digests = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(b"hot")).otherwise(F.col("id").cast("string").cast("binary")).alias("digest"),
                                       F.col("id").alias("row")).repartition(6)
    heavy = exact_dedup.heavy_digests(digests, counters=8).collect()
    assert [(bytes(r.digest), r.group_size, r.winner.doc_id) for r in heavy] == [(b"hot", 1000, 2997)]


@pytest.mark.parametrize("counters", [2, 1024])
def test_one_row_of_each_text_stays(spark, counters):
    rows = odd_rows() + prose(200) + [doc(500, "hot")] * 50
    docs = with_clashes(frame(spark, rows))
    left = exact_dedup.drop_copies(docs, counters)
    assert left.columns == docs.columns
    kept = left.collect()
    assert sorted(lower(r.text) for r in kept) == sorted({lower(r[1]) for r in rows})
    best = {h: k for _, k, _, h in by_hand(rows)}
    assert all(r.doc_id == best[hashlib.sha256(lower(r.text)).hexdigest()] and r["digest"] == "own digest" for r in kept)


def test_empty(spark):
    assert exact_dedup.copy_groups(spark.createDataFrame([], DOC)).count() == 0
    assert exact_dedup.drop_copies(spark.createDataFrame([], DOC)).count() == 0
