"""F4-F6, F8, F10-F12: the best pairs of blocks of records rank as all scored pairs do."""

import re

import pytest
from pyspark.sql import functions as F

from kinweave.operators import blocking as B

COLUMNS = ["name_clean", "name_core", "name_key", "name_alt", "street", "house_num", "city", "state", "locality", "unit", "addr_clean"]


def records(spark, n, src, countries):
    rows = [(f"S{src}-{i}", countries[i % len(countries)], src, f"w{i % 3} w{i % 5}", f"oak w{i % 4}", str(i % 6), f"c{i % 2}") for i in range(n)]
    df = spark.createDataFrame(rows, "entity_id string, country string, src int, name_core string, street string, house_num string, city string")
    return df.withColumns({"name_clean": F.col("name_core"), "name_key": F.col("name_core")} | {c: F.lit("") for c in COLUMNS if c not in df.columns and not c.startswith("name_c") and c != "name_key"})


@pytest.mark.parametrize("left,right", [(7, 11), (8192, 32768)])
def test_blocks_rank_as_all_pairs(spark, monkeypatch, left, right):
    monkeypatch.setattr(B, "LEFT", left)
    monkeypatch.setattr(B, "RIGHT", right)
    s1, x = records(spark, 40, 1, ["US", "India"]), records(spark, 50, 2, ["US", "Atlantis", "India"]).unionByName(records(spark, 20, 3, ["US"]))
    f1, fx = B.record_features(s1), B.record_features(x).join(B.tag_groups(s1, x).select("entity_id", "src", "grp"), ["entity_id", "src"])
    for cap, forward, reverse in ((20, 4, 2), (2000, 30, 3)):
        want = B.rank_candidates(B.score_pairs(f1, fx, cap), forward, reverse).collect()
        got = B.rank_candidates(B.best_pairs(f1, fx, cap, forward, reverse), forward, reverse).collect()
        assert want and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_no_records(spark):
    s1, x = records(spark, 3, 1, ["US"]), records(spark, 3, 2, ["US"])
    for a, b in ((s1.limit(0), x), (s1, x.limit(0))):
        fx = B.record_features(b).join(B.tag_groups(a, b).select("entity_id", "src", "grp"), ["entity_id", "src"])
        assert B.best_pairs(B.record_features(a), fx, 20, 4, 2).count() == 0


def test_flagship_leaves_the_scored_pairs_unmade(spark):
    """the flagship's plan sums no table of scored pairs."""
    from kinweave import queries as Q

    text = Q.flagship(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "CoGroup" in text and "sum((times" not in text.replace("cast(", "")


def test_only_candidates_leave_the_blocks(spark, monkeypatch):
    """lists of the blocks are merged before they are written out, so no more rows leave than are candidates."""
    monkeypatch.setattr(B, "LEFT", 7)
    monkeypatch.setattr(B, "RIGHT", 11)
    s1, x = records(spark, 60, 1, ["US"]), records(spark, 90, 2, ["US"])
    f1, fx = B.record_features(s1), B.record_features(x).join(B.tag_groups(s1, x).select("entity_id", "src", "grp"), ["entity_id", "src"])
    want = B.rank_candidates(B.score_pairs(f1, fx, 2000), 4, 2).collect()
    got = B.best_pairs(f1, fx, 2000, 4, 2).select("s1_id", "x_id", "src", "score").collect()
    assert sorted(map(tuple, got)) == sorted(tuple(r)[:4] for r in want)


def test_repeated_ids(spark, monkeypatch):
    """an id with several records, also of several countries or equal ones, adds up what they share."""
    from kinweave.plans.linkage import candidates

    monkeypatch.setattr(B, "CHUNK", 3)
    s1 = records(spark, 40, 1, ["US", "India"])
    other = s1.where("entity_id in ('S1-1', 'S1-6')")
    s1 = s1.unionByName(other.withColumn("country", F.lit("US"))).unionByName(other.withColumn("name_core", F.lit("w1 w9"))).unionByName(other)
    x = records(spark, 50, 2, ["US", "Atlantis", "India"])
    x = x.unionByName(x.where("entity_id in ('S2-0', 'S2-4')").withColumn("house_num", F.lit("3")))
    f1, fx = B.record_features(s1), B.record_features(x).join(B.tag_groups(s1, x).select("entity_id", "src", "grp"), ["entity_id", "src"])
    want = B.rank_candidates(B.score_pairs(f1, fx, 2000), 4, 2).collect()
    assert sorted(map(tuple, candidates(s1, x, 2000, 4, 2).collect())) == sorted(map(tuple, want))


def test_addresses_are_read_once(spark):
    """equal addresses of a country are normalized once, and every entity gets its fields."""
    from kinweave.plans.linkage import normalize

    rows = [(f"S2-{i}", f"Acme {i}", " 12 Oak St, Pune " if i % 2 else None, "India" if i % 3 else None) for i in range(12)]
    made = normalize(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    assert "Deduplicate [business_address" in made._jdf.queryExecution().analyzed().toString()
    got = {r["entity_id"]: (r["name_raw"], r["house_num"], r["country"], r["addr_missing"]) for r in made.collect()}
    assert got == {e: (n, "12" if a else "", c or "", 0 if a else 1) for e, n, a, c in rows}


def test_reports_shuffle_pairs_once(spark):
    """candidates are gathered by s1_id, not by pair; repeated pairs and truth without a match count as before."""
    from kinweave.operators import reports as T

    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-1", "S2-1"), ("S1-2", None), ("S1-3", "S2-3")], "s1_id string, x_id string")
    cands = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-1"), ("S1-1", "S2-9"), ("S1-2", "S2-3"), ("S1-9", "S2-3")], "s1_id string, x_id string")
    s1 = spark.createDataFrame([(f"S1-{i}", "US") for i in (1, 2, 3)], "entity_id string, country string")
    report = T.blocking_report(s1.select(F.col("entity_id").alias("s1_id")), truth, cands)
    recall = T.recall_by_group(truth, cands, s1)
    assert not re.search(r"hashpartitioning\(s1_id#\d+, x_id", report._jdf.queryExecution().executedPlan().toString())
    assert tuple(report.first())[:3] == (1.0, 0.333333, 0.333333)
    assert [tuple(r) for r in recall.collect()] == [("US", 0.5, 0.0)]
