"""Decision ladders over literal rows: against SQL over every precedence of two, and against rows typed from the rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyforge.functions import numbers, pages
from tallyforge.operators import features
from tallyforge.operators import ladders as L
from tallyforge.plans import ladders
from tallyforge.plans.fixtures import twin


@pytest.mark.parametrize("name", sorted(ladders.STAGES))
def test_every_precedence(name, spark):
    facts, layers, results = ladders.STAGES[name]
    rows = [(k, *r.values()) for k, r in enumerate(facts.pairs())]
    columns = ["row_id", *facts.facts]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} {k[0]}" for c, k in facts.kinds.items()))
    got = sorted(map(tuple, ladders.through(df, layers).select("row_id", *results).collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE r (row_id BIGINT, " + ", ".join(f"{c} {k[1]}" for c, k in facts.kinds.items()) + ")")
    con.executemany(f"INSERT INTO r VALUES ({', '.join('?' * len(columns))})", rows)
    want = sorted(con.execute(f"SELECT row_id, {', '.join(results)} FROM {twin('r', *layers)} t").fetchall())
    rounded = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert rounded(got) == rounded(want)
    assert len(results) == 0 or len({r[1:] for r in got}) > 1


def outcome(spark, layers, rows, *results):
    """Results of rows of facts."""
    kinds = {bool: "boolean", int: "int", float: "double", str: "string"}
    names = list(rows[0])
    schema = ", ".join(f"{c} {kinds[type(next(r[c] for r in rows if r[c] is not None))]}" for c in names)
    df = spark.createDataFrame([(k, *(r[c] for c in names)) for k, r in enumerate(rows)], f"n long, {schema}")
    return [tuple(r[c] for c in results) for r in ladders.through(df, layers).orderBy("n").collect()]


def test_sales_variance(spark):
    base = {"model": 100.0, "opportunity": 0.0, "account_opportunity": 0.0, "rep": 0.0, "lead": 0.0, "final_value": 0.0, "final_source": "", "offices": 0, "employees": 0, "closing_evidence": False, "sales_age_months": 1.0, "model_confidence": "High"}
    cases = [
        ({"opportunity": 104.0}, ("Latest New Business Opportunity", "anchor_echo_not_independent", "No_immediate_review")),
        ({"opportunity": 3.0, "model": 7.0}, ("Latest New Business Opportunity", "anchor_echo_not_independent", "No_immediate_review")),
        ({"account_opportunity": 40.0, "model": 150.0}, ("Account Latest New Business Opp MCV", "model_much_higher", "P2_review")),
        ({"rep": 40.0, "model": 150.0, "offices": 3}, ("Account Rep Qualified MCV", "model_much_higher", "P1_possible_sales_underestimate")),
        ({"rep": 40.0, "model": 150.0, "employees": 20, "model_confidence": "Low"}, ("Account Rep Qualified MCV", "model_much_higher", "P2_review")),
        ({"lead": 40.0, "model": 95.0}, ("Converted Lead Sales MCV", "model_higher", "P2_review")),
        ({"lead": 40.0, "model": 85.0}, ("Converted Lead Sales MCV", "directionally_aligned", "No_immediate_review")),
        ({"final_value": 400.0, "final_source": "inside SALES"}, ("Account Final MCV - Sales Source", "sales_much_higher", "P1_possible_model_underestimate")),
        ({"opportunity": 400.0, "sales_age_months": 24.5}, ("Latest New Business Opportunity", "sales_much_higher", "P2_review")),
        ({"opportunity": 400.0, "sales_age_months": None}, ("Latest New Business Opportunity", "sales_much_higher", "P1_possible_model_underestimate")),
        ({"opportunity": 220.0}, ("Latest New Business Opportunity", "sales_higher", "P2_review")),
        ({"opportunity": 320.0, "model": 110.0}, ("Latest New Business Opportunity", "sales_higher", "P2_review")),
        ({"final_value": 400.0, "final_source": "import"}, ("", None, None)),
        ({"model": 0.0, "opportunity": 400.0}, ("Latest New Business Opportunity", None, None)),
    ]
    assert outcome(spark, (L.VARIANCE,), [base | c for c, _ in cases], "value_source", "variance_class", "review_priority") == [w for _, w in cases]


def test_post_retrieval(spark):
    base = dict.fromkeys(("customer", "has_parent", "denied_domain", "underwriter_domain", "rollup_domain", "abstract_domain", "named_control", "preflight_duplicate", "law_firm", "green_control", "anchor", "thin_evidence"), False)
    base |= {"route": "", "original": "score_now", "retrieval": "ok", "expected_control": "", "score_confidence": "High"}
    cases = [
        ({}, ("scoreable_icp", "score_now", "High")), ({"score_confidence": ""}, ("scoreable_icp", "score_now", "Medium")), ({"thin_evidence": True}, ("scoreable_icp", "score_now", "Low")),
        ({"expected_control": "website_mismatch_review"}, ("website_mismatch_review", "route_ops_review", "High")), ({"expected_control": "parent_child_rollup_review"}, ("parent_child_rollup_review", "roll_to_parent_review", "High")),
        ({"retrieval": "map_failed"}, ("insufficient_public_evidence", "suppress_score", "High")), ({"retrieval": "map_failed", "anchor": True}, ("scoreable_icp", "score_now", "High")),
        ({"law_firm": True}, ("legal_market_or_dominance_review", "route_ops_review", "High")), ({"law_firm": True, "route": "legal_affiliated_title_entity"}, ("scoreable_icp", "score_now", "High")), ({"original": "hygiene_review"}, ("website_hygiene_review", "website_review", "High")),
        ({"customer": True, "has_parent": True}, ("duplicate_or_existing_customer_review", "route_ops_review", "High")), ({"underwriter_domain": True, "rollup_domain": True}, ("parent_child_rollup_review", "roll_to_parent_review", "High")),
    ]
    assert outcome(spark, (L.POST_RETRIEVAL,), [base | c for c, _ in cases], "disposition", "action", "gate_confidence") == [w for _, w in cases]


def test_url_health(spark):
    base = {"error_code": 0, "error": "", "from_url": False, "suspended": False, "parked": False, "placeholder": False, "title": "", "http_status": 200}
    cases = [
        ({}, "ok"), ({"error_code": 403}, "blocked"), ({"error_code": 502}, "server_error"), ({"error_code": 404}, "http_404"), ({"error": "getaddrinfo failed", "from_url": True}, "dns_error"), ({"error": "refused", "from_url": True}, "url_error"), ({"error": "refused"}, "error"),
        ({"http_status": 410}, "http_410"), ({"http_status": 401}, "blocked"), ({"http_status": 399}, "ok"), ({"parked": True, "http_status": 500}, "parked_or_for_sale"), ({"title": " Coming Soon "}, "parked_or_placeholder"),
    ]
    assert outcome(spark, (L.URL_HEALTH,), [base | c for c, _ in cases], "url_state") == [(w,) for _, w in cases]


def test_history_flags(spark):
    base = {"warehouse_id": "", "direct": 0, "rollup_usage": 0, "billable": 0, "closed": 0, "won": 0, "mcv": 0.0, "arr": 0.0, "churns": 0, "churn_date": "", "churn_exception": "", "unbilled_exception": "", "subscription": ""}
    cases = [({}, (False, False)), ({"warehouse_id": "w"}, (True, False)), ({"unbilled_exception": "T"}, (False, True)), ({"churn_exception": "yes"}, (False, True)), ({"subscription": "Expired"}, (False, True)), ({"churns": 1}, (False, True)), ({"churn_date": "2024"}, (False, True)), ({"unbilled_exception": "no"}, (False, False))]
    assert outcome(spark, (L.HISTORY,), [base | c for c, _ in cases], "has_warehouse_match", "has_retention_risk") == [w for _, w in cases]
    assert len(L.HISTORY) == 9


PAGE = "account string, url string, title string, text string, observed string"


def test_entity_safe(spark):
    """Offices by the pages that support them, people by their roles; a footer on every page is no office."""
    footer = "Footer\n9 Elm Ave, Reno, NV 89501"
    pages_ = [
        ("a", "https://x.com/contact/", "Contact", "Visit us\n**12 Oak Street, Suite 4,**\nReno, NV 89501-1234\n" + footer.replace("Footer", "-\n-\n-\nend"), "d1"),
        ("a", "https://x.com/offices", "Offices", "Our main office: 12 Oak St. Suite 4, Reno, NV 89501", "d1"),
        ("a", "https://x.com/team/ann", "Ann", "Ann Lee | Escrow Officer\n7 Pine Rd, Elko, NV 89801\nBob Ray, Attorney\nCy Dun - President\nDee Fox\nTitle Smith", "d1"),
        ("a", "https://x.com/reviews", "Customer story", "Eve Gray: Closer\n5 Ash Ln, Elko, NV 89801\nWe offer title insurance and escrow services.", "d2"),
        ("a", "https://x.com/p1", "P", "x\n3 Fir Ct, Elko, NV 89801", "d2"),
        *(("b", f"https://y.com/{k}", "Page", footer, "d1") for k in range(3)),
        ("c", "https://z.com/", "", None, None),
    ]
    df = spark.createDataFrame(pages_, PAGE)
    o = {(r.account, r.address): (r.status, r.confidence, r.reasons, r.pages) for r in features.offices(features.office_occurrences(df)).collect()}
    assert o["a", "12 oak st suite 4 reno nv 89501"] == ("verified", 0.97, "operating_office_corroborated", 2)
    assert o["a", "7 pine rd elko nv 89801"] == ("excluded", 0.96, "attorney_bio", 1) and o["a", "5 ash ln elko nv 89801"] == ("excluded", 0.96, "customer_or_testimonial", 1)
    assert o["a", "3 fir ct elko nv 89801"] == ("uncertain", 0.55, "address_without_operating_office_context", 1) and o["b", "9 elm ave reno nv 89501"] == ("excluded", 0.92, "repeated_footer_without_office_context", 3)
    s = {r.person: (r.category, r.role) for r in features.staff(features.staff_occurrences(df)).collect()}
    assert s == {"ann lee": ("relevant_operational", "Escrow Officer"), "bob ray": ("legal_professional_non_operational", "Attorney"), "cy dun": ("generic_employee_non_operational", "President"), "dee fox": ("unverified_name", ""), "eve gray": ("excluded_context", "Closer")} | {k: v for k, v in s.items() if k in ("visit us",)}
    accounts = spark.createDataFrame([("a", True, 25), ("b", True, 0), ("c", False, 7), ("d", None, None)], "account string, strong boolean, links int")
    got = {r.account: r for r in features.entity_safe(df, accounts).collect()}
    assert (got["a"].offices_low, got["a"].staff, got["a"].services, got["a"].sophistication, got["a"].confidence) == (o_verified(o, "a"), 1, "escrow; title_insurance", "high", "High")
    assert (got["b"].offices, got["b"].confidence, got["b"].codes) == (0, "Low", "repeated_footer_without_office_context")
    assert got["c"].codes == got["d"].codes == "upstream_identity_or_sellable_gate_not_strong" and got["d"].sophistication == "low"


def o_verified(offices, account):
    return sum(v[0] == "verified" for (a, _), v in offices.items() if a == account)


def test_visible_staff(spark):
    texts = [
        ("a", "Our team\nAnn B. Lee\nClosing officer\n\nBob Ray, President\nTitle Officer\nphone Carl Dun\nlower case\nDan Fox Hill West East\nEve O'Hara-Smith, Attorney", ["Ann B. Lee", "Bob Ray", "Eve O'Hara-Smith"]),
        ("b", "Ann Lee\nline\nline\nline\nowner", []),
        ("c", "", []),
    ]
    df = spark.createDataFrame([t[:2] for t in texts], "k string, t string")
    assert {r.k: r.s for r in df.select("k", pages.visible_staff(F.col("t")).alias("s")).collect()} == {k: w for k, _, w in texts}


def test_ceiling(spark):
    row = spark.range(1).select(numbers.cohort_ceiling(F.lit(50.0), F.lit(True)), numbers.cohort_ceiling(F.lit(5000.0), F.lit(False)), numbers.cohort_ceiling(F.lit(100.0), F.lit(True))).first()
    assert tuple(row) == (250.0, 2500.0, 300.0)
