"""The pipeline's decision stages over facts that orders choose; tests hold each over literal rows that meet every rule and every precedence of two."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import ladders as L
from tallyforge.plans.catalog import query
from tallyforge.plans.fixtures import Fixture, pairwise, twin
from tallyforge.sources.tables import tables

_NO, _YES = [False, True], [True, False]


#: Name to facts, layers and results, for tests.
STAGES: dict[str, tuple[Fixture, tuple, tuple[str, ...]]] = {}


def through(df: DataFrame, layers: tuple) -> DataFrame:
    for layer in layers:
        df = layer.apply(df) if isinstance(layer, (L.Ladder, L.Ledger)) else L.derive(df, layer)
    return df


def _stage(name: str, facts: Fixture, layers: tuple, results: tuple[str, ...]) -> None:
    """Registers a stage: its facts, then the layers' columns, of which the results are returned."""
    STAGES[name] = facts, layers, results

    @query(name, f"SELECT {', '.join(('row_id', *results))} FROM {twin(facts.sql, *layers)} r")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return through(facts.frame(spark, sf_dir), layers).select("row_id", *results)


_stage(
    "website_binding",
    pairwise({
        "has_site": _YES, "registrable": _YES, "directory": _NO, "generic": _NO, "hygiene_bad": _NO, "country_conflict": _NO, "state_conflict": _NO, "geo_conflict": _NO, "phone_conflict": _NO,
        "entity_class": ["title_escrow", "legal", "bank_credit_union", "organization", "association_directory_profile", "abstract_only"], "crm_class": ["title_escrow", "mortgage_lender", "legal", ""], "name_score": [1.0, 0.82, 0.7, 0.1, 0.97],
        "domain_score": [0.0, 0.5, 1.0], "phone_match": _NO, "address_match": _NO, "geo_match": _NO, "registry_match": _NO, "has_names": _YES, "has_addresses": _NO, "has_phones": _NO, "member_confirmed": _NO,
    }),
    (L.BINDING_FACTS, L.BINDING), ("site_class", "proofs", "identity_score", "status", "confidence", "reason"),
)
_TEXTS = ["", "Attorney Directory of the county", "register of deeds", "A university where students meet", "Member FDIC", "mortgage company nmls 4", "Homes for sale by realtors", "homes for sale, title company", "claims adjuster", "1031 exchange", "title insurance underwriter", "a saas platform", "title search and abstracting", "abstract company with escrow", "Law firm of attorneys at law", "real estate closings", "bakery"]
_stage("site_entity_class", pairwise({"site_text": _TEXTS, "explicit": ["", "credit union", "law firm"], "suffix": ["com", "gov", "edu"], "directory": _NO}), (L.SITE_TEXT, L.SITE_CLASS), ("entity_class",))
_stage("crm_entity_class", pairwise({"company_type": ["", "Bank", "Mortgage lender", "Real Estate Agent", "County government", "College", "Insurance agency", "Software vendor", "1031 exchange", "Owned Direct", "Law Firm", "Title & Escrow", "Other"]}), (L.CRM_CLASS,), ("crm_class",))
_stage("membership_corroboration", pairwise({"member": ["yes", "no", "", None], "match_confidence": ["High", "medium", "Low", None], "member_name": ["Oak Title", ""], "member_similarity": [0.9, 0.68, 0.5], "state": ["tx", "", "ca"], "member_state": ["tx", "", "ny"]}), (L.MEMBERSHIP,), ("member_confirmed", "member_reason"))
_stage(
    "sellable_unit",
    pairwise({
        "id": ["a1"], "active_flag": _NO, "inactive_flag": _NO, "revenue": [0.0, 9.5], "status_text": ["", "former customer", "current customer"], "account_type": ["prospect", "customer", "partner", "", "other"], "company_type": ["title", "vendor of tools", "channel partner"],
        "survivor": ["", "a1", "s9"], "loser": _NO, "duplicate_high": _NO, "owned_direct": _NO, "owned_parent": ["", "o5"], "dba_parent": ["", "d3"], "branch_parent": ["", "b4"], "parent": ["", "p2"], "hint": ["", "dba of", "branch", "central rollup"], "independent": _NO,
        "central": _NO, "domain_customers": _NO, "shared_domain": _NO, "cluster_size": [0, 1, 2], "has_members": _NO, "binding_status": ["bound", "", "ambiguous"], "binding_confidence": ["High", "Medium"],
    }),
    (L.LIFECYCLE, L.RELATION, L.UNIT), ("lifecycle", "relationship", "relation_reason", "surviving_id", "suggested_id", "eligible", "unit_confidence"),
)
_stage(
    "lane_classifier",
    pairwise({
        "is_law": _NO, "affiliated": _NO, "closing": [0, 1, 2], "weak": [0, 1], "general": [0, 1, 2], "attorney_state": _NO, "owned_direct": _NO, "underwriter": _NO, "brokerage_affiliation": _NO, "operator": [0, 1, 2], "adjacent": ["", *L.ADJACENT_LANES], "adjacent_site": _NO,
        "abstract": _NO, "title_wording": _NO, "binding_status": ["bound", "ambiguous"], "binding_confidence": ["High", "Medium"], "unit_eligible": _YES, "unit_confidence": ["High", "Low"], "lifecycle": ["net_new", "winback"],
    }),
    (L.LANE, L.LANE_ELIGIBLE), ("lane", "subtype", "lane_eligible", "lane_confidence", "lane_reason", "eligible_for_value"),
)
_LEGAL = {"is_law": _YES, "title_in_name": _NO, "closing": [0, 1, 3], "operational": [0, 1, 2], "title_services": [0, 1], "general": [0, 1, 3, 4], "national": _NO, "market": ["standard", "attorney_primary", "county_nuanced"], "offices": [0, 1, 2, 5, 10], "staff": [0, 10], "quality": [0, 3, 4]}
_stage("legal_entity_route", pairwise(_LEGAL), (L.BROAD, L.LEGAL_ROUTE, L.LEGAL_FLOOR), ("broad", "route", "legal_floor"))
_stage("capacity_estimate", pairwise({"offices": [0, 1, 2, 4, 7, 10, 15, 20], "staff": [0, 9, 20, 25], "quality": [0, 3, 4], "services": [0, 2], "national": _NO, "tools": _NO, "nationals_segment": _NO, "legal_floor": [0, 50, 150], "anchor": [0, 60, 500, 900, 2000], "customer": _NO, "context": _NO, "is_law": _NO, "legal_eligible": _NO}), (L.CAPACITY, L.ESTIMATE), ("capacity", "floored", "anchored", "estimate"))
_stage("source_anchor_fallback", pairwise({"anchor": [0, 750, 900], "customer": _NO, "non_icp": _NO, "is_law": _NO, "legal_non_icp": _NO, "legal_review": _NO, "operator_words": _YES}), (L.FALLBACK,), ("fallback_candidate", "fallback_allowed", "fallback_review"))
_stage("website_quality", pairwise({"mapped_pages": [0, 8], "contact_page": _NO, "offices": [0, 1], "team_page": _NO, "staff": [0, 3], "services": [0, 3], "tools": _NO, "quality_words": _NO}), (L.QUALITY,), ("quality",))
_stage(
    "scorer_routing",
    pairwise({"has_site": _YES, "hygiene_control": _NO, "customer_anchor": _NO, "map_failed": _NO, "fallback_allowed": _NO, "fallback_review": ["", "above"], "legal_eligible": _NO, "has_text": _YES, "legal_non_icp": _NO, "legal_review": _NO, "non_icp": _NO, "icp_likely": _YES, "pages": [0, 2], "offices": [0, 1, 2], "quality": [0, 3], "staff": [0, 5], "legal_raise": _NO}),
    (L.SCORER, L.SCORE_CONFIDENCE), ("review_action", "score_confidence"),
)
_stage("preflight_gate", pairwise({"has_site": _YES, "customer": _NO, "hard_status": _NO, "has_parent": _NO, "owned_domain": _NO, "underwriter_domain": _NO, "association_domain": _NO, "other_class_domain": _NO, "customer_on_domain": _NO, "bad_hygiene": _NO, "non_icp_type": _NO, "positive_type": _YES, "member": _NO}), (L.PREFLIGHT,), ("disposition", "action", "gate_confidence"))
_stage(
    "quality_overlay",
    pairwise({"owned_direct": _NO, "underwriter": _NO, "positive": _YES, "non_icp_type": _NO, "customer_domain": _NO, "has_parent": _NO, "rollup_domain": _NO, "bank_domain": _NO, "government_domain": _NO, "association_domain": _NO, "known_mismatch": _NO, "brokerage_domain": _NO, "name_mismatch": _NO, "abstract_only": _NO, "original": ["score_now", "non_icp_confirmed", "search_fallback_needed"], "retrieval": ["ok", "", "map_failed"], "quality": [4, 2, 0], "offices": [1, 20], "member": _NO}),
    (L.OVERLAY,), ("disposition", "action", "gate_confidence"),
)
_stage(
    "post_retrieval_gate",
    pairwise({"customer": _NO, "has_parent": _NO, "denied_domain": _NO, "underwriter_domain": _NO, "rollup_domain": _NO, "abstract_domain": _NO, "named_control": _NO, "preflight_duplicate": _NO, "law_firm": _NO, "route": ["", "legal_affiliated_title_entity", "legal_market_review"], "green_control": _NO, "original": ["score_now", "non_icp_confirmed", "hygiene_review", "other"], "retrieval": ["ok", "map_failed"], "anchor": _NO, "expected_control": ["", "parent_child_rollup_review", "website_mismatch_review"], "thin_evidence": _NO, "score_confidence": ["Medium", "High", "", "Low"]}),
    (L.POST_RETRIEVAL,), ("disposition", "action", "gate_confidence"),
)
_stage(
    "top_rank_guardrails",
    pairwise({"tier": ["tier_1_trusted_anchor", "tier_0_retained_v1", "tier_2_usable_website_score", "tier_3_entity_fallback"], "detail": ["trusted_final_mcv", "won_mcv"], "anchor": [800, 700], "binding_status": ["mismatch", "bound"], "lane": ["title_escrow", "legal"], "subtype": ["unclear_broad_practice", "real_estate_closing_focused"], "title_corroborated": _NO, "supports": [0, 1], "value": [900, 150, 60]}),
    (L.GUARDRAIL, L.GUARDED), ("ceiling", "guardrail_reason", "guarded_value", "guardrail_applied"),
)
_stage(
    "entity_controls",
    pairwise({"id": ["a1"], "host": ["oak.com", "oak.co.uk", "oak.us", "oak.de"], "tier": ["tier_0_retained_v1", "tier_1_trusted_anchor"], "us_based": _YES, "location_cited": _NO, "shared_high": _NO, "survivor": ["", "a1", "b2"], "value": [400, 90], "cohort_value": [120]}),
    (L.ENTITY_CONTROL,), ("foreign_conflict", "control", "controlled_value"),
)
_stage("url_health", pairwise({"error_code": [0, 403, 503, 404], "error": ["", "getaddrinfo failed", "read timed out", "bad certificate", "refused"], "from_url": _NO, "suspended": _NO, "parked": _NO, "placeholder": _NO, "title": ["Oak Title", " Coming Soon "], "http_status": [200, 401, 302, 500]}), (L.URL_HEALTH,), ("url_state",))
_stage(
    "overlay_actions",
    pairwise({"icp": ["ICP - Title/Settlement Agency", "ICP - Attorney Settlement Agent", "Non-ICP", ""], "registry": ["matched_active_agency", "none"], "vsb_required": ["No", "Yes"], "vsb": ["", "Pending", "Yes"], "label": ["Yes", "No", "Pending", ""], "candidate": ["", "https://oak.com"], "original_in_review": _NO}),
    (L.ICP_STATUS, L.SITE_STATUS, L.PROPOSED, L.WOULD_CHANGE), ("icp_status", "site_status", "proposed", "would_change"),
)

_NAMES = "SELECT c_custkey AS id, c_name || CASE c_nationkey % 8 WHEN 0 THEN ' Title' WHEN 1 THEN ' Law Group' WHEN 2 THEN ' Insurance' WHEN 3 THEN ' Mortgage' WHEN 4 THEN ' Software' WHEN 5 THEN ' Title LLP' WHEN 6 THEN ' & Associates' ELSE '' END AS name FROM customer"


@query("name_only_class", f"SELECT id, icp_category, priority FROM {twin(f'({_NAMES})', L.NAME_WORDS, L.NAME_CLASS)} r")
def name_only_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.expr("CASE c_nationkey % 8 WHEN 0 THEN ' Title' WHEN 1 THEN ' Law Group' WHEN 2 THEN ' Insurance' WHEN 3 THEN ' Mortgage' WHEN 4 THEN ' Software' WHEN 5 THEN ' Title LLP' WHEN 6 THEN ' & Associates' ELSE '' END")
    named = tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("id"), F.concat("c_name", words).alias("name"))
    return L.NAME_CLASS.apply(L.derive(named, L.NAME_WORDS)).select("id", "icp_category", "priority")


#: Readiness: gates over one row of figures, each PASS, FAIL or PENDING.
_GATES = (
    ("ids_unique", "orders_n = orders_distinct", "true"), ("no_missing_customer", "unmatched = 0", "true"), ("enough_rows", "orders_n >= 3000", "true"),
    ("values_positive", "least_price > 0", "true"), ("share_of_open_known", "open_share < 0.5", "true"), ("labels_present", "labels_n > 0", "labels_n IS NOT NULL"), ("novel_negatives", "toxic_n >= 5", "labels_n > 0"),
)
_FIGURES = "SELECT (SELECT count(*) FROM orders) AS orders_n, (SELECT count(DISTINCT o_orderkey) FROM orders) AS orders_distinct, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS unmatched, (SELECT min(o_totalprice) FROM orders) AS least_price, (SELECT count(*) FILTER (WHERE o_orderstatus = 'O') / count(*) FROM orders) AS open_share, (SELECT count(*) FROM labels) AS labels_n, (SELECT count(*) FILTER (WHERE toxic = 1) FROM labels) AS toxic_n"


@query("readiness_gates", " UNION ALL ".join(f"SELECT '{n}' AS gate, CASE WHEN NOT ({known}) THEN 'PENDING' WHEN {when} THEN 'PASS' ELSE 'FAIL' END AS state FROM ({_FIGURES}) f" for n, when, known in _GATES))
def readiness_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    known = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.lit(1).alias("known"))
    o = t.orders.join(known, "o_custkey", "left").agg(
        F.count("*").alias("orders_n"), F.count_distinct("o_orderkey").alias("orders_distinct"), F.count_if(F.col("known").isNull()).alias("unmatched"), F.min("o_totalprice").alias("least_price"), (F.count_if(F.col("o_orderstatus") == "O") / F.count("*")).alias("open_share"))
    n = t.labels.agg(F.count("*").alias("labels_n"), F.count_if(F.col("toxic") == 1).alias("toxic_n"))
    state = lambda when, sure: f"CASE WHEN NOT ({sure}) THEN 'PENDING' WHEN {when} THEN 'PASS' ELSE 'FAIL' END"
    gates = F.array(*(F.struct(F.lit(g).alias("gate"), F.expr(state(when, sure)).alias("state")) for g, when, sure in _GATES))
    return o.join(n).select(F.explode(gates).alias("g")).select("g.gate", "g.state")  # two rows of one line each


_stage(
    "release_hard_failures",
    pairwise({
        "score": [80.0, None], "point": [100.0, None, 0.0, 300.0], "low": [50.0, None], "high": [200.0, 60.0], "arr": [9.0, None, 50.0], "arr_low": [5.0, None], "arr_high": [20.0, 1.0], "binding_status": ["bound", "mismatch", "ambiguous"], "binding_confidence": ["high", "medium"], "active": _NO, "account_status": ["", "customer"],
        "lifecycle": ["net_new", "active_customer", "partner", "winback"], "relation": ["independent", "duplicate_loser", "branch"], "relation_confidence": ["high", "low"], "entity_class": ["title_escrow", "adjacent"], "subtype": ["operator", "underwriter", "abstract_only", "non_closing_legal"], "lane_confidence": ["high", "medium"], "original": ["High", "Medium", "Low", ""],
    }),
    (L.HARD_FAILURES, L.RELEASE_CONFIDENCE), ("failures", "release_confidence"),
)
_stage(
    "decision_acceptance",
    pairwise({
        "binding_status": ["bound", "mismatch"], "binding_confidence": ["High", "Low"], "unit_eligible": _YES, "unit_confidence": ["High", "Medium"], "lane_eligible": _YES, "lane_confidence": ["High", "Medium"], "evidence_confidence": ["High", "Low"], "pages": [2, 0], "evidence_hash": ["x", ""], "age_days": [3.5, 91.0, -1.0, None], "point": [5.0, None], "low": [1.0, None], "high": [9.0, None],
        "value_confidence": ["High", "Low"], "arr_point": [1.0, None], "comparables": [8, 7], "provisional": _NO, "lifecycle": ["net_new", "active_customer"], "relation": ["independent", "dba_alias"],
    }),
    (L.ACCEPTANCE, L.DISPOSITION), ("lacking", "disposition", "operation"),
)
_stage(
    "desired_state",
    pairwise({"id": ["a1"], "survivor": ["a1", "b2"], "operation": ["publish_value", "no_change"], "lifecycle": ["net_new", "active_customer"], "binding_status": ["bound", "ambiguous"], "confidence": ["High", "Medium"], "lane": ["legal", "adjacent"], "point": [50.0, None, 0.0, 500.0], "low": [10.0, -1.0, None], "high": [90.0, None], "arr": [5.0, None, 0.0], "arr_low": [1.0, -1.0], "arr_high": [9.0, 2.0]}),
    (L.PUBLISHABLE,), ("violations",),
)
_stage(
    "schema_validation",
    pairwise({"name": ["Value", "Id"], "actual_type": ["double", "string", "picklist", None], "expected_type": ["double", "picklist"], "updateable": _YES, "nillable": _YES, "actual_length": [80, 40], "expected_length": [0, 80, 3], "actual_precision": [18, 10], "actual_scale": [2, 0], "expected_precision": [18, 5, 0], "expected_scale": [2], "restricted": _YES, "value": ["12.5", "", "1234.567", "-7"], "value_allowed": _NO}),
    (L.SCHEMA,), ("faults",),
)
_stage("controlled_labels", pairwise({"label": ["Yes", " no ", "Pending", "", "maybe"], "icp": ["ICP", "Non-ICP", "ICP - Title/Settlement Agency", "other"], "registered": ["", "Yes", "No"], "first_pass": ["Likely ICP", "non-icp brokerage", "", "Confirmed ICP"]}), (L.LABELS,), ("yes_no", "label_state", "icp_label", "truth", "conflict", "predicted"))
_stage("registry_city_check", pairwise({"registry": ["matched_active_agency", "none"], "city": ["reno", ""], "host": ["oak.com", ""], "in_candidate_evidence": _NO, "in_evidence": _NO}), (L.CITY_CHECK,), ("city_check",))
_stage("website_candidate_grade", pairwise({"tokens": [2, 0, 1, 3], "ignored_host": _NO, "host_hits": [2, 0, 1], "strong_hits": [2, 0, 1], "hits": [2, 0, 1, 3]}), (L.CANDIDATE,), ("grade", "why"))
_stage("search_result_score", pairwise({"name_score": [0.9, 0.25, 0.1], "host_score": [0.8, 0.3, 0.0], "same_host": _NO, "entity_level": ["strong", "medium", "weak"], "directory": _NO, "non_icp": _NO, "has_icp": _NO, "state_named": _YES, "exact_name": _NO, "has_location": _NO}), (L.RESULT_SCORE,), ("level", "result_score", "result_confidence"))
_stage("resolver_outcome", pairwise({"law": _NO, "trusted": _NO, "candidate": ["High", "Medium", "Low", ""], "non_icp": _NO, "icp": _NO, "site_icp": _NO, "directory": _NO, "location": _NO}), (L.RESOLVED,), ("outcome", "outcome_confidence"))
_stage("customer_history_flags", pairwise({"warehouse_id": ["w1", "", None], "direct": [0, 5, None], "rollup_usage": [0, 5, None], "billable": [0, 1], "closed": [0, 1], "won": [0, 1], "mcv": [0.0, 2.5, None], "arr": [0.0, 2.5], "churns": [0, 1, None], "churn_date": ["", "2024-01-01", None], "churn_exception": ["", "TRUE", "no"], "unbilled_exception": ["", "yes", None], "subscription": ["active", "Expired", None]}), (L.HISTORY,), tuple(n for n, _ in L.HISTORY))
_stage(
    "sales_model_variance",
    pairwise({"model": [100.0, 0.0, 20.0, 400.0, 52.0, 1000.0], "opportunity": [0.0, 300.0, 50.0, 104.0], "account_opportunity": [0.0, 80.0], "rep": [0.0, 40.0], "lead": [0.0, 90.0, 1000.0], "final_value": [200.0, 0.0, 33.0], "final_source": ["Sales rep", "Marketing"], "offices": [0, 3], "employees": [0, 20], "closing_evidence": [False, True], "sales_age_months": [1.0, 24.0, 24.5, None], "model_confidence": ["High", "Low", "Medium"]}),
    (L.VARIANCE,), ("sales_value", "value_source", "variance_class", "review_priority"),
)
_stage("first_pass_labels", pairwise({"has_candidate": _YES, "strong": _NO, "registry": ["none", "matched_active_agency"], "vsb_required": _NO, "outcome": ["unresolved", "high_confidence_recovery", "reviewer_assist"]}), (L.FIRST_PASS,), tuple(n for n, _ in L.FIRST_PASS))
