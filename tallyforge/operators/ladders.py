"""Decision ladders as data: ordered SQL conditions over a row's facts, first match wins, several outcome columns at once.

A ladder becomes one CASE for each outcome, so a whole ladder costs one projection: no shuffle, no Python.  Conditions
are written in SQL that Spark reads as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Sql(str):
    """An outcome that is not a constant but an expression over the row's facts."""


def literal(v: object) -> str:
    if isinstance(v, Sql):
        return v
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, (int, float)) else f"'{v}'"


@dataclass(frozen=True)
class Ladder:
    #: Names of the outcomes.
    outcomes: tuple[str, ...]
    #: (condition, a value for each outcome).
    rules: tuple[tuple[str, tuple], ...]
    default: tuple

    def cases(self) -> dict[str, str]:
        """A CASE for each outcome."""
        return {name: "CASE " + " ".join(f"WHEN {when} THEN {literal(values[k])}" for when, values in self.rules) + f" ELSE {literal(self.default[k])} END" for k, name in enumerate(self.outcomes)}

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: F.expr(case) for name, case in self.cases().items()})


@dataclass(frozen=True)
class Ledger:
    """Names of all rules that hold, in order, as one text."""

    name: str
    rules: tuple[tuple[str, str], ...]

    def apply(self, df: DataFrame) -> DataFrame:
        found = F.array(*(F.when(F.expr(when), F.lit(n)) for n, when in self.rules))
        return df.withColumn(self.name, F.array_join(F.array_compact(found), "; "))


def derive(df: DataFrame, steps: tuple[tuple[str, str], ...]) -> DataFrame:
    """Columns by SQL, each seeing those before it."""
    for name, sql in steps:
        df = df.withColumn(name, F.expr(sql))
    return df


# ---- website binding ---------------------------------------------------------------------------------------------------

#: Classes of sites beside the market, and those of the market.
ADJACENT = ("bank_credit_union", "mortgage_lender", "brokerage_real_estate_agency", "government_county", "education", "insurance_public_adjuster", "software_vendor_competitor", "1031_qi", "underwriter_owned_direct")
CORE = ("title_escrow", "legal")
_ADJACENT, _CORE = (", ".join(map(literal, x)) for x in (ADJACENT, CORE))

#: What a site's text says of its class, in order.
SITE_CLASS = Ladder(
    ("entity_class",),
    (
        ("directory OR regexp_like(t, r'\\b(member|business|attorney) directory\\b|\\bcompany profile\\b')", ("association_directory_profile",)),
        ("suffix = 'gov' OR regexp_like(t, r'\\b(county (?:clerk|recorder|government)|register of deeds|municipal government|state agency)\\b')", ("government_county",)),
        ("suffix = 'edu' OR regexp_like(t, r'\\b(university|college)\\b.*\\b(admissions|students?|campus|academic)\\b')", ("education",)),
        ("regexp_like(t, r'\\bcredit union\\b|\\bmember fdic\\b|\\bpersonal (?:checking|banking)\\b')", ("bank_credit_union",)),
        ("regexp_like(t, r'\\b(nmls|mortgage lender|home loan lender|mortgage company)\\b')", ("mortgage_lender",)),
        ("NOT title_service AND regexp_like(t, r'\\b(real estate brokerage|real estate agency|realtors?|mls listings?|homes for sale)\\b')", ("brokerage_real_estate_agency",)),
        ("regexp_like(t, r'\\b(public adjuster|insurance adjusting|claims adjuster)\\b')", ("insurance_public_adjuster",)),
        ("regexp_like(t, r'\\b(qualified intermediary|1031 exchange|section 1031)\\b')", ("1031_qi",)),
        ("regexp_like(t, r'\\b(underwriter owned|direct operation|title insurance underwriter)\\b')", ("underwriter_owned_direct",)),
        ("NOT title_service AND regexp_like(t, r'\\b(software (?:company|platform|vendor)|saas platform|technology vendor|competitor)\\b')", ("software_vendor_competitor",)),
        ("regexp_like(t, r'\\b(abstracting|abstract company|title search)\\b') AND NOT regexp_like(t, r'\\b(escrow|settlement|closing services?|conduct closings?)\\b')", ("abstract_only",)),
        ("regexp_like(t, r'\\b(law firm|attorneys? at law|legal counsel)\\b')", ("legal",)),
        ("title_service", ("title_escrow",)),
    ),
    ("organization",),
)
SITE_TEXT = (("t", "lower(concat(explicit, ' ', site_text))"), ("title_service", "regexp_like(t, r'\\b(title (?:company|agency|insurance)|escrow|settlement|real estate closings?)\\b')"))

#: A customer system's company type as a class, in order.
CRM_CLASS = Ladder(
    ("crm_class",),
    tuple(
        (f"regexp_like(lower(company_type), '{pattern}')", (name,))
        for pattern, name in (
            ("bank|credit union", "bank_credit_union"), ("mortgage|lender", "mortgage_lender"), ("broker|real estate agent|builder", "brokerage_real_estate_agency"), ("government|county", "government_county"),
            ("college|university|education", "education"), ("public adjuster|insurance agency", "insurance_public_adjuster"), ("vendor|competitor|software", "software_vendor_competitor"),
            ("1031|qualified intermediary", "1031_qi"), ("underwriter|owned direct", "underwriter_owned_direct"), ("law firm|legal", "legal"), ("title|escrow|settlement", "title_escrow"),
        )
    ),
    ("",),
)

#: Corroboration by a trade association's member list: never a site's only proof.
MEMBERSHIP = Ladder(
    ("member_confirmed", "member_reason"),
    (
        ("member IS NULL OR member = ''", (False, None)),
        ("NOT lower(member) IN ('1', 'true', 't', 'yes', 'y')", (False, "alta_member_false_or_missing")),
        ("coalesce(CASE lower(match_confidence) WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END, 0) < 2", (False, "alta_match_confidence_below_threshold")),
        ("member_name <> '' AND member_similarity < 0.68", (False, "alta_name_mismatch")),
        ("state <> '' AND member_state <> '' AND state <> member_state", (False, "alta_state_mismatch")),
    ),
    (True, "alta_entity_confirmed"),
)

#: Weights of the identity score, what agreement adds to it and conflict takes away, and its thresholds.
BINDING_FACTS = (
    ("site_class", f"CASE WHEN entity_class = 'organization' AND crm_class IN ({_ADJACENT}, 'abstract_only') THEN crm_class ELSE entity_class END"),
    ("class_conflict", f"site_class IN ({_ADJACENT}) AND crm_class IN ({_CORE})"),
    ("reverse_conflict", f"site_class IN ({_CORE}) AND crm_class IN ({_ADJACENT})"),
    ("other_proofs", "CAST(domain_score >= 0.5 AS INT) + CAST(phone_match AS INT) + CAST(address_match AS INT) + CAST(geo_match AS INT) + CAST(registry_match AS INT)"),
    ("proofs", "other_proofs + CAST(name_score >= 0.82 AS INT)"),
    ("weighted", "CAST(0.58 AS DOUBLE) * name_score + CAST(0.18 AS DOUBLE) * domain_score + CAST(0.2 AS DOUBLE) * CAST(phone_match AS INT) + CAST(0.16 AS DOUBLE) * CAST(address_match AS INT) + CAST(0.12 AS DOUBLE) * CAST(geo_match AS INT) + CAST(0.16 AS DOUBLE) * CAST(registry_match AS INT)"),
    ("agreed", "weighted + CASE WHEN name_score >= 0.82 AND other_proofs > 0 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END - CASE WHEN phone_conflict THEN CAST(0.08 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END - CASE WHEN geo_conflict THEN CAST(0.06 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"),
    ("identity_score", "greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), agreed))"),
)
BINDING = Ladder(
    ("status", "confidence", "reason"),
    (
        ("NOT has_site", ("no_website", "Low", "website_missing")),
        ("NOT registrable", ("insufficient_evidence", "Low", "website_host_invalid")),
        ("directory OR entity_class = 'association_directory_profile'", ("mismatch", "High", "directory_or_profile_not_owned_site")),
        ("generic", ("hygiene_review", "Low", "generic_host_requires_tenant_validation")),
        ("hygiene_bad", ("mismatch", "High", "authoritative_hygiene_mismatch")),
        ("country_conflict", ("mismatch", "High", "international_country_conflict")),
        ("name_score >= 0.82 AND (state_conflict OR (geo_conflict AND phone_conflict))", ("mismatch", "High", "same_name_contact_or_geo_conflict")),
        ("class_conflict AND (name_score < 0.97 OR NOT (phone_match OR address_match OR registry_match))", ("mismatch", "High", "site_entity_class_conflicts_with_account")),
        ("reverse_conflict", ("ambiguous", "Medium", "crm_site_entity_class_requires_review")),
        ("name_score >= 0.82 AND proofs >= 2 AND identity_score >= 0.86", ("bound", "High", "website_bound_to_account")),
        ("has_names AND name_score < 0.25 AND (phone_conflict OR geo_conflict OR class_conflict)", ("mismatch", "High", "site_self_identifies_as_different_entity")),
        ("identity_score >= 0.68 OR (name_score >= 0.82 AND proofs = 1)", ("ambiguous", "Medium", "website_binding_requires_review")),
        ("member_confirmed", ("insufficient_evidence", "Low", "alta_cannot_be_sole_website_proof")),
        ("NOT has_names AND NOT has_addresses AND NOT has_phones", ("insufficient_evidence", "Low", "cached_site_identity_evidence_missing")),
    ),
    ("ambiguous", "Low", "website_binding_unresolved"),
)

# ---- sellable unit -----------------------------------------------------------------------------------------------------

LIFECYCLE = Ladder(
    ("lifecycle", "lifecycle_confidence", "lifecycle_reason"),
    (
        ("active_flag", ("active_customer", "High", "active_customer_flag")),
        ("revenue > 0 OR regexp_like(status_text, r'\\b(active customer|current customer|live subscription|contracted)\\b')", ("active_customer", "High", "active_customer_status")),
        ("regexp_like(status_text, r'\\b(churned|former customer|lapsed|cancelled|terminated customer|inactive customer)\\b')", ("winback", "High", "churned_or_former_customer")),
        ("account_type IN ('customer', 'client')", ("active_customer", "Medium", "crm_customer_type")),
        ("account_type LIKE '%partner%' OR company_type LIKE '%partner%'", ("partner", "High", "crm_partner_type")),
        ("regexp_like(company_type, 'competitor|vendor|government|education')", ("excluded", "High", "crm_excluded_company_type")),
        ("account_type IN ('prospect', 'target', 'lead') AND inactive_flag", ("net_new", "High", "explicit_non_customer_prospect")),
        ("account_type IN ('prospect', 'target', 'lead', '')", ("net_new", "Medium", "no_customer_lifecycle_evidence")),
    ),
    ("unknown", "Low", "lifecycle_unresolved"),
)
RELATION = Ladder(
    ("relation", "relation_confidence", "sellable", "relation_reason"),
    (
        ("survivor <> '' AND survivor <> id AND (loser OR duplicate_high)", ("duplicate_loser", "High", False, "verified_duplicate_survivor")),
        ("owned_direct OR owned_parent <> ''", ("owned_direct_operation", "Medium", False, "owned_direct_requires_parent_review")),
        ("(dba_parent <> '' OR hint LIKE '%dba%') AND independent", ("independent_dba", "Medium", True, "dba_independent_contracting")),
        ("dba_parent <> '' OR hint LIKE '%dba%'", ("dba_alias", "High", False, "dba_rolls_to_legal_entity")),
        ("(branch_parent <> '' OR regexp_like(hint, r'\\b(branch|location|office)\\b')) AND independent", ("independent_branch", "Medium", True, "branch_independent_contracting")),
        ("branch_parent <> '' OR regexp_like(hint, r'\\b(branch|location|office)\\b')", ("branch_location", "High", False, "branch_not_standalone")),
        ("parent <> '' AND (central OR regexp_like(hint, 'non.?independent|central|rollup'))", ("non_independent_child", "High", False, "parent_central_contracting_evidence")),
        ("parent <> '' AND independent", ("independent_child", "High", True, "child_has_independent_buying_evidence")),
        ("parent <> ''", ("parent_child_review", "Medium", False, "parent_link_without_buying_independence_evidence")),
        ("domain_customers", ("shared_domain_customer_review", "Low", False, "shared_domain_insufficient_for_customer_ownership")),
        ("shared_domain", ("shared_domain_only_review", "Low", False, "shared_domain_insufficient_for_duplicate_or_parent")),
        ("cluster_size > 1", ("shared_domain_cluster_review", "Low", False, "shared_domain_cluster_members_unresolved")),
        ("has_members", ("surviving_parent", "Medium", True, "account_has_related_members")),
        ("cluster_size = 1", ("independent", "High", True, "unique_domain_no_hierarchy_relationship_evidence")),
    ),
    ("independent", "Medium", True, "no_rollup_relationship_evidence"),
)
UNIT = (
    ("bound_high", "lower(binding_status) = 'bound' AND lower(binding_confidence) = 'high'"),
    ("relationship", "CASE WHEN relation = 'independent' AND lifecycle = 'active_customer' THEN 'active_customer' WHEN relation = 'independent' AND lifecycle = 'winback' THEN 'churned_winback' ELSE relation END"),
    ("surviving_id", "CASE WHEN relation = 'duplicate_loser' THEN survivor WHEN relation = 'owned_direct_operation' THEN coalesce(nullif(owned_parent, ''), nullif(parent, ''), id) WHEN relation = 'dba_alias' THEN coalesce(nullif(dba_parent, ''), nullif(parent, ''), id) WHEN relation = 'branch_location' THEN coalesce(nullif(branch_parent, ''), nullif(parent, ''), id) WHEN relation = 'non_independent_child' THEN parent ELSE id END"),
    ("suggested_id", "CASE WHEN relation = 'parent_child_review' THEN parent ELSE surviving_id END"),
    ("eligible", "sellable AND lifecycle = 'net_new' AND bound_high"),
    ("unit_confidence", "CASE WHEN lifecycle_confidence = 'Low' OR binding_status = '' THEN 'Low' WHEN relation_confidence = 'High' AND (lifecycle_confidence = 'Medium' OR NOT bound_high) THEN 'Medium' ELSE relation_confidence END"),
)

# ---- lanes -------------------------------------------------------------------------------------------------------------

#: Kinds beside the market in the order in which they are looked for.
ADJACENT_LANES = ("bank", "lender", "brokerage", "government", "education", "adjuster", "software", "1031")
_LEGAL = "is_law AND "
#: Facts: counts of distinct labels (closing, weak, general, operator) and flags; adjacent is a kind or '', adjacent_site whether the site says it.
LANE = Ladder(
    ("lane", "subtype", "lane_eligible", "lane_confidence", "lane_reason"),
    (
        (_LEGAL + "affiliated AND (closing > 0 OR weak > 0)", ("legal", "affiliated_title_entity", True, "High", "legal_affiliated_title_evidence")),
        (_LEGAL + "closing >= 2 AND general <= 1", ("legal", "real_estate_closing_focused", True, "High", "legal_operational_closing_evidence")),
        (_LEGAL + "closing >= 1 AND general <= 1", ("legal", "real_estate_closing_focused", True, "Medium", "legal_operational_closing_evidence")),
        (_LEGAL + "closing >= 1", ("legal", "general_practice_meaningful_re_closing_arm", True, "Medium", "legal_broad_practice_evidence")),
        (_LEGAL + "weak > 0", ("legal", "unclear_broad_practice", False, "Medium", "legal_real_estate_practice_not_operationally_proven")),
        (_LEGAL + "general >= 2", ("legal", "non_closing_legal", False, "High", "legal_non_closing_practice_evidence")),
        (_LEGAL + "general >= 1", ("legal", "non_closing_legal", False, "Medium", "legal_non_closing_practice_evidence")),
        (_LEGAL + "attorney_state", ("legal", "state_market_review", False, "Medium", "legal_state_market_review_required")),
        ("is_law", ("legal", "unclear_broad_practice", False, "Low", "legal_practice_evidence_insufficient")),
        ("owned_direct", ("title_escrow", "owned_direct", False, "High", "owned_direct_relationship_not_standalone")),
        ("underwriter", ("title_escrow", "underwriter", False, "High", "title_underwriter_not_standalone_prospect")),
        ("brokerage_affiliation AND operator > 0", ("title_escrow", "brokerage_affiliated", False, "High", "brokerage_affiliation_requires_sellable_unit_review")),
        *((f"adjacent = '{k}' AND adjacent_site", ("adjacent", f"adjacent_{k}", False, "High", f"adjacent_{k}")) for k in ADJACENT_LANES),
        *((f"adjacent = '{k}'", ("adjacent", f"adjacent_{k}", False, "Medium", f"adjacent_{k}")) for k in ADJACENT_LANES),
        ("abstract AND operator = 0", ("title_escrow", "abstract_only", False, "Medium", "abstract_only_closing_operation_unproven")),
        ("operator >= 2", ("title_escrow", "title_escrow_settlement_operator", True, "High", "title_escrow_operational_evidence")),
        ("operator = 1", ("title_escrow", "title_escrow_settlement_operator", True, "Medium", "title_escrow_operational_evidence")),
        ("title_wording", ("title_escrow", "ambiguous", False, "Low", "title_lane_operating_evidence_insufficient")),
    ),
    ("review", "ambiguous", False, "Low", "no_explicit_icp_lane_evidence"),
)
LANE_ELIGIBLE = (("eligible_for_value", "lane_eligible AND binding_status IN ('bound', 'correct_website', 'confirmed') AND binding_confidence = 'High' AND unit_eligible AND unit_confidence = 'High' AND lifecycle = 'net_new'"),)

# ---- legal routes and value estimates ------------------------------------------------------------------------------------

#: Legal routes; facts are counts (closing, operational, general, title_services, offices) and flags.
BROAD = (("broad", "general >= 4 OR (general >= 3 AND (offices >= 5 OR national)) OR (general >= 1 AND offices >= 10 AND national)"), ("favourable", "market IN ('attorney_primary', 'attorney_relevant', 'county_nuanced')"))
LEGAL_ROUTE = Ladder(
    ("route",),
    (
        ("NOT is_law", ("not_legal_entity",)),
        ("title_in_name AND (closing >= 1 OR title_services >= 1)", ("legal_affiliated_title_entity",)),
        ("NOT broad AND (operational >= 2 OR (operational >= 1 AND title_services >= 1))", ("legal_affiliated_title_entity",)),
        ("broad AND (closing > 0 OR title_services > 0)", ("legal_real_estate_practice_unclear",)),
        ("broad", ("legal_general_practice_low_fit",)),
        ("operational >= 1 AND favourable", ("legal_real_estate_closing_focused",)),
        ("closing >= 3 AND general <= 2 AND title_services >= 1", ("legal_real_estate_closing_focused",)),
        ("closing >= 1 OR title_services >= 1", ("legal_real_estate_practice_unclear",)),
        ("general >= 1", ("legal_general_practice_low_fit",)),
        ("favourable", ("legal_market_review",)),
    ),
    ("legal_general_practice_low_fit",),
)
#: Least estimates of legal entities by market, offices, staff and website quality.
_RETAINED = "route IN ('legal_real_estate_closing_focused', 'legal_affiliated_title_entity')"
LEGAL_FLOOR = Ladder(
    ("legal_floor",),
    (
        (f"NOT ({_RETAINED})", (None,)),
        ("offices >= 4 AND favourable", (150,)), ("offices >= 4", (125,)),
        ("offices >= 2 AND (staff >= 10 OR quality >= 4) AND favourable", (100,)), ("offices >= 2 AND (staff >= 10 OR quality >= 4)", (75,)),
        ("offices >= 2 AND favourable", (75,)), ("offices >= 2", (50,)),
        ("offices >= 1 AND (staff >= 10 OR quality >= 4) AND favourable", (75,)), ("offices >= 1 AND (staff >= 10 OR quality >= 4)", (50,)),
        ("favourable AND quality >= 3", (50,)),
    ),
    (None,),
)
#: Capacity by offices, staff, quality and services, in order of precedence.
CAPACITY = Ladder(
    ("capacity",),
    (
        ("offices >= 20", (750,)), ("offices >= 15", (500,)), ("offices >= 10", (350,)), ("offices >= 7", (225,)),
        ("offices >= 4 AND (staff >= 20 OR quality >= 4)", (175,)), ("offices >= 4", (125,)),
        ("offices >= 2 AND (staff >= 20 OR quality >= 4)", (125,)), ("offices >= 2", (75,)),
        ("offices = 1 AND (staff >= 20 OR quality >= 4 OR national)", (75,)), ("offices = 1", (40,)),
        ("national AND quality >= 3", (125,)), ("staff >= 20", (100,)), ("quality >= 4", (62,)), ("services >= 2", (40,)),
    ),
    (25,),
)
_CAP = "CASE WHEN NOT is_law OR NOT legal_eligible OR anchor > 0 THEN NULL WHEN offices <= 1 AND staff < 10 THEN 50 WHEN offices = 2 AND staff < 10 THEN CASE WHEN staff >= 6 AND quality >= 4 THEN 100 WHEN quality >= 3 THEN 75 ELSE 50 END END"
#: Raising and capping an estimate by a known figure (anchor, 0 if none is trusted).
ESTIMATE = (
    ("toolled", "CASE WHEN tools THEN greatest(capacity, 62) ELSE capacity END"),
    ("segmented", "CASE WHEN nationals_segment AND toolled < 100 AND (national OR quality >= 4) THEN 100 ELSE toolled END"),
    ("floored", "greatest(segmented, coalesce(legal_floor, 0))"),
    ("corroborated", "anchor <= floored * 2 OR (context AND ((NOT is_law AND anchor <= 1500) OR (offices >= 7 AND anchor <= 800) OR (((offices >= 4 AND (staff >= 20 OR quality >= 4)) OR (staff >= 25 AND quality >= 4)) AND anchor <= greatest(floored * 3, 500))))"),
    ("anchored", "CASE WHEN anchor <= 0 THEN floored WHEN anchor > floored THEN CASE WHEN customer OR corroborated THEN anchor WHEN NOT context THEN floored ELSE floored * 2 END ELSE least(floored, anchor * 2) END"),
    ("estimate", f"least(anchored, coalesce({_CAP}, anchored))"),
)
#: A source's figure as fallback where retrieval said little, and why not.
FALLBACK = (
    ("fallback_candidate", "anchor > 0 AND NOT customer AND NOT non_icp AND NOT (is_law AND (legal_non_icp OR legal_review)) AND operator_words"),
    ("fallback_allowed", "fallback_candidate AND anchor <= 750"),
    ("fallback_review", "CASE WHEN fallback_candidate AND anchor > 750 THEN 'source_figure_above_ceiling' ELSE '' END"),
)
#: The five tests of website quality.
QUALITY = (("quality", "CAST(mapped_pages >= 8 AS INT) + CAST(contact_page OR offices > 0 AS INT) + CAST(team_page OR staff > 0 AS INT) + CAST(services >= 3 AS INT) + CAST(tools OR quality_words AS INT)"),)

#: Route of a row through the scorer.
SCORER = Ladder(
    ("review_action",),
    (
        ("(NOT has_site OR hygiene_control) AND NOT customer_anchor", ("hygiene_review",)),
        ("customer_anchor", ("score_now",)),
        ("map_failed AND fallback_allowed", ("score_now",)), ("map_failed AND fallback_review <> ''", ("plausibility_review",)), ("map_failed", ("insufficient_public_evidence",)),
        ("legal_eligible", ("score_now",)), ("fallback_allowed", ("score_now",)), ("fallback_review <> ''", ("plausibility_review",)),
        ("NOT has_text", ("insufficient_public_evidence",)), ("legal_non_icp", ("non_icp_confirmed",)), ("legal_review", ("legal_review",)), ("non_icp", ("non_icp_confirmed",)), ("NOT icp_likely", ("insufficient_public_evidence",)),
    ),
    ("score_now",),
)
SCORE_CONFIDENCE = Ladder(
    ("score_confidence",),
    (
        ("review_action = 'insufficient_public_evidence' OR (review_action <> 'score_now' AND pages = 0)", ("Low",)),
        ("review_action IN ('non_icp_confirmed', 'hygiene_review')", ("High",)), ("review_action <> 'score_now'", ("Medium",)),
        ("offices >= 2 AND quality >= 3", ("High",)), ("legal_raise", ("Medium",)), ("offices >= 1 OR staff >= 5 OR pages >= 2", ("Medium",)),
    ),
    ("Low",),
)

# ---- gates -------------------------------------------------------------------------------------------------------------

_GATE = ("disposition", "action", "gate_confidence")
PREFLIGHT = Ladder(
    _GATE,
    (
        ("NOT has_site", ("missing_website", "website_review", "High")),
        ("customer", ("existing_customer_review", "route_ops_review", "High")),
        ("hard_status", ("crm_status_suppressed", "suppress_score", "High")),
        ("has_parent", ("parent_child_rollup_review", "roll_to_parent_review", "High")),
        ("owned_domain", ("owned_or_rollup_domain_review", "roll_to_parent_review", "High")),
        ("underwriter_domain", ("underwriter_or_direct_side_review", "route_ops_review", "High")),
        ("association_domain", ("website_mismatch_review", "website_review", "High")),
        ("other_class_domain AND (positive_type OR member)", ("website_or_entity_review", "website_review", "Medium")),
        ("other_class_domain", ("website_or_entity_review", "suppress_score", "High")),
        ("customer_on_domain", ("duplicate_or_existing_customer_review", "route_ops_review", "High")),
        ("bad_hygiene", ("website_hygiene_review", "website_review", "High")),
        ("non_icp_type AND member", ("crm_company_type_review", "route_ops_review", "Medium")),
        ("non_icp_type", ("crm_company_type_suppressed", "suppress_score", "High")),
        ("NOT positive_type AND NOT member", ("manual_ops_review", "route_ops_review", "Medium")),
        ("member", ("scoreable_icp", "allow_score", "High")),
    ),
    ("scoreable_icp", "allow_score", "Medium"),
)
OVERLAY = Ladder(
    _GATE,
    (
        ("owned_direct", ("underwriter_or_direct_side_review", "route_ops_review", "High")),
        ("underwriter AND positive", ("underwriter_or_direct_side_review", "route_ops_review", "High")),
        ("underwriter", ("suppress_non_icp", "suppress_score", "High")),
        ("non_icp_type AND NOT positive", ("suppress_non_icp", "suppress_score", "High")),
        ("customer_domain", ("existing_customer_duplicate_review", "route_ops_review", "High")),
        ("has_parent OR rollup_domain", ("rollup_or_duplicate_review", "roll_to_parent_review", "High")),
        ("(bank_domain OR government_domain) AND positive", ("website_mismatch_review", "website_review", "Medium")),
        ("bank_domain OR government_domain", ("suppress_wrong_website", "suppress_score", "High")),
        ("association_domain", ("suppress_wrong_website", "suppress_score", "High")),
        ("known_mismatch", ("website_mismatch_review", "website_review", "High")),
        ("brokerage_domain AND positive AND name_mismatch", ("ops_review", "route_ops_review", "High")),
        ("brokerage_domain AND positive", ("ops_review", "route_ops_review", "Medium")),
        ("brokerage_domain AND name_mismatch", ("suppress_non_icp", "suppress_score", "High")),
        ("brokerage_domain", ("suppress_non_icp", "suppress_score", "Medium")),
        ("abstract_only", ("abstract_only_review", "route_ops_review", "Medium")),
        ("original IN ('insufficient_public_evidence', 'search_fallback_needed', 'url_enrichment_needed')", ("insufficient_public_evidence", "route_ops_review", "High")),
        ("original = 'non_icp_confirmed'", ("suppress_non_icp", "suppress_score", "High")),
        ("retrieval <> '' AND retrieval <> 'ok'", ("insufficient_public_evidence", "route_ops_review", "Medium")),
        ("quality > 0 AND quality <= 2 AND offices >= 20", ("ops_review", "route_ops_review", "Medium")),
        ("name_mismatch AND offices >= 20 AND original = 'score_now'", ("website_mismatch_review", "website_review", "Medium")),
        ("member", ("scoreable", "allow_score", "High")),
    ),
    ("scoreable", "allow_score", "Medium"),
)
_NOT_NOW = "original <> 'score_now' AND "
POST_RETRIEVAL = Ladder(
    _GATE,
    (
        ("customer", ("duplicate_or_existing_customer_review", "route_ops_review", "High")),
        ("has_parent", ("parent_child_rollup_review", "roll_to_parent_review", "High")),
        ("denied_domain", ("website_mismatch_review", "website_review", "High")),
        ("underwriter_domain AND rollup_domain", ("parent_child_rollup_review", "roll_to_parent_review", "High")),
        ("underwriter_domain", ("underwriter_or_direct_side_review", "route_ops_review", "High")),
        ("abstract_domain", ("abstract_only_review", "suppress_score", "High")),
        ("named_control", ("non_icp_confirmed", "suppress_score", "High")),
        ("preflight_duplicate", ("duplicate_or_existing_customer_review", "route_ops_review", "High")),
        (f"law_firm AND NOT ({_RETAINED})", ("legal_market_or_dominance_review", "route_ops_review", "High")),
        (_NOT_NOW + "green_control", ("insufficient_public_evidence", "route_ops_review", "Medium")),
        (_NOT_NOW + "original = 'non_icp_confirmed'", ("non_icp_confirmed", "suppress_score", "High")),
        (_NOT_NOW + "original = 'hygiene_review'", ("website_hygiene_review", "website_review", "High")),
        (_NOT_NOW + "law_firm", ("legal_market_or_dominance_review", "route_ops_review", "Medium")),
        ("original <> 'score_now'", ("insufficient_public_evidence", "suppress_score", "High")),
        ("retrieval IN ('map_failed', 'extract_failed', 'script_error', 'not_run') AND NOT anchor", ("insufficient_public_evidence", "suppress_score", "High")),
        ("expected_control <> '' AND expected_control = 'parent_child_rollup_review'", ("parent_child_rollup_review", "roll_to_parent_review", "High")),
        ("expected_control <> ''", (Sql("expected_control"), "route_ops_review", "High")),
        ("thin_evidence", ("scoreable_icp", "score_now", "Low")),
    ),
    ("scoreable_icp", "score_now", Sql("coalesce(nullif(trim(score_confidence), ''), 'Medium')")),
)

#: Ceilings of top-ranked estimates without support.
GUARDRAIL = Ladder(
    ("ceiling", "guardrail_reason"),
    (
        ("tier = 'tier_1_trusted_anchor' AND detail = 'trusted_final_mcv' AND anchor >= 750 AND binding_status IN ('mismatch', 'insufficient', 'insufficient_evidence') AND lane = 'title_escrow' AND NOT title_corroborated", (225, "uncorroborated_750_final_mcv_with_untrusted_binding")),
        ("tier = 'tier_1_trusted_anchor' AND detail = 'trusted_final_mcv' AND anchor >= 750 AND binding_status IN ('mismatch', 'insufficient', 'insufficient_evidence') AND lane <> 'title_escrow' AND supports = 0", (75, "uncorroborated_750_final_mcv_with_untrusted_binding")),
        ("lane = 'legal' AND subtype IN ('unclear_broad_practice', 'non_closing_legal') AND tier IN ('tier_0_retained_v1', 'tier_2_usable_website_score') AND value >= 200 AND supports = 0", (75, "unsupported_200_plus_broad_or_non_closing_legal_estimate")),
    ),
    (None, ""),
)
GUARDED = (("guarded_value", "CASE WHEN value > ceiling THEN ceiling ELSE value END"), ("guardrail_applied", "guardrail_reason <> ''"))

#: Foreign hosts and shared domains of high values.
ENTITY_CONTROL = (
    ("last_label", "regexp_extract(host, r'\\.([a-z]+)$', 1)"),
    ("foreign_conflict", "tier IN ('tier_0_retained_v1', 'tier_2_usable_website_score') AND us_based AND length(last_label) = 2 AND last_label <> 'us' AND NOT location_cited"),
    ("control", "CASE WHEN foreign_conflict THEN 'foreign_domain_entity_conflict' WHEN NOT shared_high THEN '' WHEN survivor = id THEN 'shared_domain_sellable_survivor' WHEN survivor <> '' THEN 'shared_domain_non_survivor' ELSE 'shared_domain_unresolved_high_value' END"),
    ("controlled_value", "CASE WHEN control IN ('foreign_domain_entity_conflict', 'shared_domain_non_survivor', 'shared_domain_unresolved_high_value') THEN least(value, cohort_value) ELSE value END"),
)

#: Words of parked, suspended and placeholder pages are facts; this is their order.
URL_HEALTH = Ladder(
    ("url_state",),
    (
        ("error_code IN (401, 403)", ("blocked",)), ("error_code BETWEEN 500 AND 599", ("server_error",)), ("error_code > 0", (Sql("concat('http_', error_code)"),)),
        ("regexp_like(lower(error), 'name or service not known|getaddrinfo failed')", ("dns_error",)), ("regexp_like(lower(error), 'timed out|timeout')", ("timeout",)), ("regexp_like(lower(error), 'ssl|certificate')", ("ssl_error",)), ("error <> '' AND from_url", ("url_error",)), ("error <> ''", ("error",)),
        ("suspended", ("suspended_or_inactive",)), ("parked", ("parked_or_for_sale",)), ("placeholder OR lower(trim(title)) IN ('coming soon', 'under construction', 'website coming soon')", ("parked_or_placeholder",)),
        ("http_status IN (401, 403)", ("blocked",)), ("http_status >= 200 AND http_status < 400", ("ok",)),
    ),
    (Sql("concat('http_', http_status)"),),
)

_VSB = "vsb_required = 'Yes' AND vsb IN ('', 'Pending')"
ICP_STATUS = Ladder(
    ("icp_status",),
    (
        ("icp = 'ICP - Title/Settlement Agency' AND registry = 'matched_active_agency'", ("registry_confirmed_title_settlement_icp",)), ("icp = 'ICP - Title/Settlement Agency'", ("title_settlement_icp_provisional",)),
        ("icp = 'ICP - Attorney Settlement Agent' AND vsb = 'Yes'", ("attorney_settlement_icp_vsb_confirmed",)), (f"icp = 'ICP - Attorney Settlement Agent' AND {_VSB}", ("attorney_settlement_candidate_vsb_pending",)), ("icp = 'ICP - Attorney Settlement Agent'", ("attorney_settlement_icp_provisional",)),
        ("icp = 'Non-ICP'", ("non_icp_candidate",)), (_VSB, ("law_firm_vsb_pending",)),
    ),
    ("unknown",),
)
SITE_STATUS = Ladder(("site_status",), (("label = 'Yes'", ("candidate_website_confirmed",)), ("label = 'No'", ("candidate_website_rejected",)), ("label = 'Pending'", ("candidate_website_pending",)), ("candidate <> ''", ("candidate_website_unlabeled",))), ("no_candidate_website",))
_SURE = "site_status = 'candidate_website_confirmed'"
PROPOSED = Ladder(
    ("proposed",),
    (
        ("site_status = 'candidate_website_rejected'", ("wrong_website_confirmed",)),
        (f"icp = 'ICP - Title/Settlement Agency' AND {_SURE}", ("resolver_overlay_rescore_candidate",)), ("icp = 'ICP - Title/Settlement Agency' AND registry = 'matched_active_agency'", ("registry_confirmed_website_needed",)),
        (f"icp = 'ICP - Attorney Settlement Agent' AND {_SURE} AND {_VSB}", ("law_firm_rescore_candidate_pending_vsb",)), (f"icp = 'ICP - Attorney Settlement Agent' AND {_SURE}", ("attorney_settlement_rescore_candidate",)),
        (_VSB, ("law_firm_vsb_review_needed",)), ("icp = 'Non-ICP'", ("non_icp_confirmed_by_overlay",)), (_SURE, ("candidate_website_review_needed",)),
    ),
    ("no_overlay_change",),
)
WOULD_CHANGE = Ladder(
    ("would_change",),
    (("proposed = 'no_overlay_change'", ("No",)), ("original_in_review", ("Yes",)), ("proposed IN ('wrong_website_confirmed', 'non_icp_confirmed_by_overlay')", ("Yes",)), ("proposed LIKE '%rescore_candidate' OR proposed = 'law_firm_rescore_candidate_pending_vsb'", ("Review",))),
    ("No",),
)

#: Words of a name that say what its bearer does.
NAME_WORDS = (
    ("is_title", "regexp_like(lower(name), 'title|escrow|closing|settlement|abstract')"),
    ("is_law", "regexp_like(concat(' ', lower(name), ' '), r'llp|p\\.c\\.| p\\.c | attorney|attorneys| law|& associates| law group')"),
    ("is_insurer", "regexp_like(lower(name), 'insurance|underwriter|guaranty')"),
    ("is_bank", "regexp_like(lower(name), 'bank|mortgage|lending|lender|credit union')"),
    ("is_vendor", "regexp_like(lower(name), 'solutions|technology|software|consulting|services|technical|association|member|warranty|brief|tour')"),
)
NAME_CLASS = Ladder(
    ("icp_category", "priority"),
    (
        ("is_title AND NOT is_law AND NOT is_bank AND NOT is_insurer", ("likely_title_agency", "High")), ("is_law AND NOT is_title", ("likely_law_firm", "Medium")), ("is_insurer", ("likely_underwriter_or_insurer", "Skip")),
        ("is_bank", ("likely_bank_or_lender", "Skip")), ("is_vendor AND NOT is_title", ("likely_service_vendor", "Review")),
    ),
    ("unclear", "Review"),
)

# ---- release -----------------------------------------------------------------------------------------------------------

#: What keeps a scored account out of a release; all that hold are named.
HARD_FAILURES = Ledger(
    "failures",
    (
        ("invalid_numeric_score", "score IS NULL"),
        ("invalid_numeric_mcv", "coalesce(low <= 0 OR point <= 0 OR high <= 0, true)"),
        ("invalid_mcv_interval", "low > 0 AND point > 0 AND high > 0 AND NOT (low <= point AND point <= high)"),
        ("invalid_numeric_arr", "coalesce(arr <= 0, true) OR arr_low IS NULL OR arr_high IS NULL"),
        ("invalid_arr_interval", "arr > 0 AND (arr_low > arr_high OR NOT (arr_low <= arr AND arr <= arr_high))"),
        ("confirmed_website_entity_mismatch", "binding_status = 'mismatch' AND binding_confidence = 'high'"),
        ("confirmed_active_customer", "active OR account_status IN ('active', 'active customer', 'customer') OR lifecycle = 'active_customer'"),
        ("confirmed_partner", "lifecycle = 'partner'"),
        ("verified_duplicate_loser", "relation_confidence = 'high' AND relation = 'duplicate_loser'"),
        ("confirmed_non_independent_sellable_unit", "relation_confidence = 'high' AND relation IN ('non_independent_child', 'branch', 'dba', 'owned_direct', 'brokerage_affiliated', 'parent_controlled')"),
        ("confirmed_non_icp_entity", "entity_class = 'adjacent' AND lane_confidence = 'high'"),
        *((f"confirmed_{k}_non_independent", f"subtype = '{k}' AND lane_confidence = 'high'") for k in ("underwriter", "owned_direct", "brokerage_affiliated")),
        ("confirmed_abstract_only", "subtype = 'abstract_only'"),
        ("confirmed_nonclosing_legal_non_icp", "subtype = 'non_closing_legal' AND lane_confidence = 'high'"),
    ),
)
RELEASE_CONFIDENCE = Ladder(
    ("release_confidence",),
    (
        ("original = 'Low' OR lifecycle IN ('winback', 'unknown') OR original NOT IN ('High', 'Medium')", ("Low",)),
        ("relation <> 'independent' OR binding_status IN ('ambiguous', 'insufficient_evidence', 'hygiene_blocked')", ("Medium",)),
        ("original = 'High' AND binding_status = 'bound' AND binding_confidence = 'high' AND lane_confidence = 'high'", ("High",)),
    ),
    ("Medium",),
)
#: The conjuncts of automatic acceptance: what an account lacks, and what is done with it.
ACCEPTANCE = Ledger(
    "lacking",
    (
        ("binding", "NOT (binding_status = 'bound' AND binding_confidence = 'High')"), ("unit", "NOT (unit_eligible AND unit_confidence = 'High')"), ("lane", "NOT (lane_eligible AND lane_confidence = 'High')"), ("evidence", "evidence_confidence <> 'High'"),
        ("pages", "pages <= 0 OR evidence_hash = ''"), ("freshness", "age_days IS NULL OR age_days < 0 OR age_days > 90"), ("value_interval", "point IS NULL OR low IS NULL OR high IS NULL"), ("value_confidence", "value_confidence <> 'High'"),
        ("comparables", "arr_point IS NULL OR comparables < 8"), ("provisional", "provisional"),
    ),
)
DISPOSITION = Ladder(
    ("disposition", "operation"),
    (
        ("lacking = ''", ("accepted", "publish_value")),
        ("lifecycle = 'active_customer'", ("active_customer_no_change", "no_change")),
        ("relation IN ('duplicate_loser', 'non_independent_child', 'branch_location', 'dba_alias', 'owned_direct_operation', 'shared_domain_customer_review', 'shared_domain_only_review', 'shared_domain_cluster_review', 'parent_child_review')", ("sellable_unit_no_change", "no_change")),
    ),
    ("review", "route_review_metadata_only"),
)
#: What an accepted decision must hold before it becomes a desired state.
PUBLISHABLE = Ledger(
    "violations",
    (
        ("operation", "operation <> 'publish_value'"), ("active_customer", "lifecycle = 'active_customer'"), ("not_net_new", "lifecycle <> 'net_new'"), ("unbound", "binding_status NOT IN ('bound', 'confirmed', 'correct_website')"), ("confidence", "confidence <> 'High'"), ("lane", "lane NOT IN ('title_escrow', 'legal')"), ("loser", "survivor <> id"),
        ("value_missing", "point IS NULL OR low IS NULL OR high IS NULL"), ("value_interval", "NOT (low <= point AND point <= high)"), ("value_sign", "point <= 0 OR low < 0 OR high <= 0"), ("arr_missing", "arr IS NULL OR arr_low IS NULL OR arr_high IS NULL"), ("arr_interval", "NOT (arr_low <= arr AND arr <= arr_high)"), ("arr_sign", "arr <= 0 OR arr_low < 0 OR arr_high <= 0"),
    ),
)
#: A described field against what is expected of it, and a value against both.
SCHEMA = Ledger(
    "faults",
    (
        ("missing", "actual_type IS NULL"), ("not_updateable", "name <> 'Id' AND updateable = false"), ("not_nillable", "name <> 'Id' AND nillable = false"), ("type", "actual_type <> expected_type"), ("length", "expected_length > 0 AND actual_length <> expected_length"),
        ("numeric", "expected_precision > 0 AND (actual_precision <> expected_precision OR actual_scale <> expected_scale)"), ("value_length", "expected_length > 0 AND length(value) > expected_length"), ("picklist", "actual_type = 'picklist' AND restricted AND value <> '' AND NOT value_allowed"),
        ("value_precision", "expected_precision > 0 AND value <> '' AND (length(regexp_replace(value, '^[^.]*[.]?', '')) > expected_scale OR greatest(1, length(regexp_replace(regexp_replace(value, '[.].*$', ''), '^-', ''))) + length(regexp_replace(value, '^[^.]*[.]?', '')) > expected_precision)"),
    ),
)

# ---- candidates, labels and history ----------------------------------------------------------------------------------------

_PEND = "('', 'pending', 'pending review', 'tbd', 'unknown')"
#: Controlled labels: yes, no or pending, anything else is invalid.
LABELS = (
    ("yes_no", "CASE lower(trim(label)) WHEN 'yes' THEN 'Yes' WHEN 'no' THEN 'No' END"),
    ("label_state", f"CASE WHEN lower(trim(label)) IN {_PEND} THEN 'pending_or_blank' WHEN yes_no IS NOT NULL THEN 'valid' ELSE 'invalid_uncontrolled_value' END"),
    ("icp_label", "CASE WHEN lower(trim(icp)) IN ('icp', 'icp - title/settlement agency', 'icp - attorney settlement agent') THEN 'ICP' WHEN lower(trim(icp)) IN ('non-icp', 'non icp') THEN 'Non-ICP' END"),
    ("truth", "CASE WHEN lower(trim(registered)) = 'yes' THEN 'ICP' ELSE icp_label END"),
    ("conflict", "CASE WHEN lower(trim(registered)) = 'yes' AND icp_label = 'Non-ICP' THEN 'conflict_vsb_yes_groundtruth_non_icp' ELSE '' END"),
    ("predicted", "CASE WHEN regexp_like(lower(first_pass), 'confirmed icp|likely icp|title/settlement icp') THEN 'ICP' WHEN regexp_like(lower(first_pass), 'non-icp|non icp') THEN 'Non-ICP' ELSE 'Unknown' END"),
)
CITY_CHECK = Ladder(
    ("city_check",),
    (("registry <> 'matched_active_agency'", ("not_applicable_no_scc_match",)), ("city = '' OR host = ''", ("not_applicable_missing_city_or_candidate",)), ("in_candidate_evidence", ("scc_city_found_in_candidate_evidence",)), ("in_evidence", ("scc_city_found_in_other_evidence",))),
    ("scc_city_not_found_in_evidence",),
)
#: A website candidate by its hits: tokens of the name, in its host, strong ones among these, in all evidence.
CANDIDATE = Ladder(
    ("grade", "why"),
    (
        ("tokens = 0", ("reject", "no usable name")), ("ignored_host", ("reject", "ignored host")), ("host_hits = 0", ("reject", "no name in host")), ("strong_hits = 0", ("reject", "weak name in host")),
        ("strong_hits >= 2 AND 2 * host_hits >= tokens AND hits >= 2 AND 100 * hits >= 67 * tokens", ("high", "host and evidence")), ("hits >= 2 AND 2 * hits >= tokens", ("medium", "host and evidence")), ("tokens = 1 AND hits >= 1", ("medium", "single name")),
    ),
    ("reject", "insufficient match"),
)
#: A search result as website candidate of an account.
RESULT_SCORE = (
    ("host_value", "CASE WHEN same_host THEN greatest(host_score, CAST(1 AS DOUBLE)) ELSE host_score END"),
    ("level", "CASE WHEN same_host AND name_score >= 0.25 AND entity_level = 'weak' THEN 'medium' ELSE entity_level END"),
    ("result_score", "CASE WHEN directory OR (non_icp AND NOT has_icp) OR level = 'weak' OR NOT (same_host OR state_named) OR (host_value < 0.25 AND NOT exact_name) THEN CAST(0 AS DOUBLE) ELSE CAST(0.55 AS DOUBLE) * name_score + CAST(0.45 AS DOUBLE) * host_value + CASE WHEN level = 'strong' THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CASE WHEN has_icp THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CASE WHEN has_location THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END"),
    ("result_confidence", "CASE WHEN result_score >= 0.85 THEN 'High' WHEN result_score >= 0.6 THEN 'Medium' WHEN result_score >= 0.45 THEN 'Low' ELSE '' END"),
)
RESOLVED = Ladder(
    ("outcome", "outcome_confidence"),
    (
        ("law AND trusted AND candidate = 'High'", ("law_firm_review", "High")), ("law", ("law_firm_review", "Medium")), ("non_icp AND NOT icp", ("non_icp_review", "Medium")), ("trusted AND site_icp AND candidate = 'High'", ("high_confidence_recovery", "High")), ("trusted", ("reviewer_assist", "Medium")),
        ("icp AND directory", ("reviewer_assist", "Medium")), ("site_icp AND candidate = 'High'", ("high_confidence_recovery", "High")), ("site_icp AND candidate = 'Medium'", ("reviewer_assist", "Medium")), ("site_icp", ("needs_review", "Low")), ("candidate IN ('High', 'Medium') OR location", ("needs_review", "Low")),
    ),
    ("unresolved", "Low"),
)
_RISK = "('true', 't', '1', 'yes')"
HISTORY = (
    ("has_warehouse_match", "coalesce(warehouse_id, '') <> ''"), ("has_direct_usage", "coalesce(direct, 0) > 0"), ("has_billing_usage", "coalesce(rollup_usage, 0) > 0"), ("has_billing_report", "coalesce(billable, 0) > 0"), ("has_history", "coalesce(closed, 0) > 0"), ("has_won", "coalesce(won, 0) > 0"), ("has_mcv_label", "coalesce(mcv, 0) > 0"), ("has_arr_label", "coalesce(arr, 0) > 0"),
    ("has_retention_risk", f"coalesce(churns, 0) > 0 OR coalesce(churn_date, '') <> '' OR lower(coalesce(churn_exception, '')) IN {_RISK} OR lower(coalesce(unbilled_exception, '')) IN {_RISK} OR lower(coalesce(subscription, '')) IN ('cancelled', 'expired')"),
)
#: How the model's figure and sales' first positive one differ, and how urgent that is.
VARIANCE = (
    ("sales_value", "coalesce(CASE WHEN opportunity > 0 THEN opportunity END, CASE WHEN account_opportunity > 0 THEN account_opportunity END, CASE WHEN rep > 0 THEN rep END, CASE WHEN lead > 0 THEN lead END, CASE WHEN final_value > 0 AND lower(final_source) LIKE '%sales%' THEN final_value END)"),
    ("value_source", "CASE WHEN opportunity > 0 THEN 'Latest New Business Opportunity' WHEN account_opportunity > 0 THEN 'Account Latest New Business Opp MCV' WHEN rep > 0 THEN 'Account Rep Qualified MCV' WHEN lead > 0 THEN 'Converted Lead Sales MCV' WHEN sales_value > 0 THEN 'Account Final MCV - Sales Source' ELSE '' END"),
    ("comparable", "model > 0 AND sales_value > 0"), ("apart", "model - sales_value"),
    ("echo", "abs(apart) <= greatest(5, sales_value * CAST(0.05 AS DOUBLE))"),
    ("variance_class", "CASE WHEN NOT coalesce(comparable, false) THEN NULL WHEN echo THEN 'anchor_echo_not_independent' WHEN model >= 3 * sales_value AND apart >= 100 THEN 'model_much_higher' WHEN model >= 2 * sales_value AND apart >= 50 THEN 'model_higher' WHEN 3 * model <= sales_value AND apart <= -100 THEN 'sales_much_higher' WHEN 2 * model <= sales_value AND apart <= -50 THEN 'sales_higher' ELSE 'directionally_aligned' END"),
    ("supported", "coalesce(offices, 0) >= 3 OR coalesce(employees, 0) >= 20 OR closing_evidence"), ("stale", "coalesce(sales_age_months, 0) > 24"),
    ("review_priority", "CASE WHEN variance_class IS NULL THEN NULL WHEN variance_class = 'model_much_higher' AND model_confidence IN ('High', 'Medium') AND supported THEN 'P1_possible_sales_underestimate' WHEN variance_class = 'sales_much_higher' AND NOT stale THEN 'P1_possible_model_underestimate' WHEN variance_class LIKE '%higher' THEN 'P2_review' ELSE 'No_immediate_review' END"),
)

#: First labels of a resolver's rows, for people to check: site, class, what it may count as, and whether it still needs a look.
_MATCHED = "registry = 'matched_active_agency'"
FIRST_PASS = (
    ("site_label", "CASE WHEN NOT has_candidate THEN 'No Candidate' WHEN strong THEN 'Likely Correct' ELSE 'Needs Human Review' END"),
    ("icp_label", f"CASE WHEN {_MATCHED} THEN 'Confirmed ICP' WHEN vsb_required THEN 'Pending VSB Review' WHEN outcome IN ('high_confidence_recovery', 'reviewer_assist') THEN 'Likely ICP' ELSE 'Unknown' END"),
    ("recovery", f"CASE WHEN site_label = 'Likely Correct' AND icp_label IN ('Confirmed ICP', 'Likely ICP') THEN CASE WHEN {_MATCHED} THEN 'Website Candidate - SCC Confirmed ICP' ELSE 'Website Candidate - SCC Silent' END WHEN {_MATCHED} AND has_candidate THEN 'SCC Confirmed ICP - Website Needs Review' WHEN {_MATCHED} THEN 'SCC Confirmed ICP - Website Still Needed' WHEN vsb_required THEN 'Pending VSB Lane' ELSE 'No First-Pass Recovery Credit' END"),
    ("label_confidence", "CASE WHEN site_label = 'Likely Correct' AND icp_label = 'Confirmed ICP' THEN 'High' WHEN site_label = 'Likely Correct' OR icp_label = 'Confirmed ICP' THEN 'Medium' ELSE 'Low' END"),
    ("review_required", "CASE WHEN site_label <> 'Likely Correct' OR icp_label IN ('Pending VSB Review', 'Unknown') OR recovery IN ('SCC Confirmed ICP - Website Needs Review', 'SCC Confirmed ICP - Website Still Needed') THEN 'Yes' ELSE 'No' END"),
)
