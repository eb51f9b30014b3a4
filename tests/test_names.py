"""Searches, votes and contracts against rows typed from their rules."""

import json

from pyspark.sql import functions as F

from tallyforge.functions import searches
from tallyforge.operators import contracts, votes


def test_registry_names(spark):
    cases = [
        ("A & B Title, L.L.C.", "www.abtitle.com", ["A and B Title", "AB Title", "A B Title", "abtitle"]),
        ("Oak Law Firm d/b/a Elm", None, ["Oak Law Firm", "oak", "oak Law"]),
        ("Big River Title Agency", "https://longertitle.org", ["Big River Title Agency", "longertitle", "big Title", "big river"]),
        ("Title Co", "", ["Title Co"]),
        (None, "x.y", []),
        ("N" * 80, "", ["N" * 50]),
    ]
    df = spark.createDataFrame([(k, n, s) for k, (n, s, _) in enumerate(cases)], "k int, n string, s string")
    got = [r.v for r in df.select("k", searches.registry_names("n", "s").alias("v")).orderBy("k").collect()]
    # the distinctive words of a name of one long word are that word, cut alike
    assert got == [w for _, _, w in cases]
    one = df.where("k = 2").select(searches.site_searches("n", F.lit(""), "s").alias("a"), searches.website_searches("n", F.lit("TX"), "s").alias("b")).first()
    assert one.a[0] == '"Big River Title Agency" "Virginia" title settlement escrow' and one.a[-1] == '"Big River Title Agency" "longertitle.org" title settlement' and len(one.a) == 7
    assert one.b[0] == '"Big River Title Agency" TX official website' and one.b[-1] == '"longertitle" "Big River Title Agency"' and len(one.b) == 5


def test_shared_survivors(spark):
    rows = [
        ("votes", "a", "", "", "", False, False, False, False), ("votes", "b", "a", "", "", True, True, True, True), ("votes", "c", "out", "b", "low", False, False, False, False),
        ("tie", "a", "b", "", "", True, True, True, True), ("tie", "b", "a", "", "", False, False, False, False),
        ("lead", "a", "", "a", "High", True, True, True, False), ("lead", "b", "", "", "", True, False, False, False),
        ("close", "a", "", "", "", True, True, True, False), ("close", "b", "", "", "", True, True, False, False),
        ("none", "a", "", "", "", False, False, False, False), ("sug", "a", "", "b", "MEDIUM", False, False, False, False), ("sug", "b", "", "", "", False, False, False, False),
    ]
    df = spark.createDataFrame(rows, "domain string, id string, parent string, suggested string, confidence string, member boolean, bound boolean, named boolean, placed boolean")
    got = {r.domain: (r.survivor, r.how) for r in votes.shared_survivors(df).collect()}
    by_votes, by_evidence, open_ = "resolved_parent_child_or_suggested_survivor", "resolved_unique_entity_location_identity", "unresolved_shared_domain"
    assert got == {"votes": ("a", by_votes), "tie": ("a", by_evidence), "lead": ("a", by_evidence), "close": ("", open_), "none": ("", open_), "sug": ("b", by_votes)}


def test_contract(spark):
    rows = [("1", "bound", "net_new", "legal", "publish_value", "true", "5", "1", "9", "High"), ("2", "bound", "net_new", "legal", "no_change", "x", "5", "6", "9", "Sure"), (None, "bound", None, "legal", "no_change", "false", None, None, None, "Low")]
    df = spark.createDataFrame(rows, "account_id string, binding_status string, lifecycle string, lane string, operation string, accepted string, point string, low string, high string, confidence string")
    out = contracts.DECISIONS.conform(df.withColumn("extra", F.lit(1)))
    assert out.columns[:2] == ["account_id", "binding_status"] and "extra" not in out.columns and dict(out.dtypes)["point"] == "double"
    assert [r.violations for r in out.collect()] == [[], ["rule:interval", "type:accepted", "value:confidence"], ["missing:account_id", "missing:lifecycle"]]
    document = json.loads(contracts.DECISIONS.documents(df).first().document)
    assert document["accepted"] is True and document["point"] == 5.0 and document["contract_version"] == contracts.VERSION and contracts.DECISIONS.documents(df).count() == 1
    lacking = contracts.LANES.conform(df.select("account_id", "lane")).first()
    assert lacking.violations == ["missing:confidence", "missing:eligible_for_value", "missing:subtype"]
