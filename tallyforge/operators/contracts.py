"""Records of a declared shape: fields with types, which of them may be missing, and the values that some may have."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "account-decision-contract-v1"
#: What the contracts' named values may be.
CONFIDENCE = ("High", "Medium", "Low")
BINDING = ("bound", "mismatch", "ambiguous", "no_website", "hygiene_review", "insufficient_evidence")
LIFECYCLE = ("net_new", "active_customer", "winback", "partner", "excluded", "unknown")
LANE = ("title_escrow", "legal", "adjacent", "review", "ineligible")
OPERATION = ("publish_value", "route_review_metadata_only", "hard_suppress_no_change", "no_change")


@dataclass(frozen=True)
class Contract:
    name: str
    #: Fields as Spark writes them.
    fields: str
    optional: tuple[str, ...] = ()
    values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: (name, SQL that a record must fulfil).
    rules: tuple[tuple[str, str], ...] = ()

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.fields)

    def conform(self, df: DataFrame) -> DataFrame:
        """df's fields in the contract's order and types, with contract_version and violations (empty for a sound record).

        A field that df lacks is missing in every record; a value that its type can't hold is a violation and reads null.
        """
        given, out, faults = dict(df.dtypes), [], []
        for f in self.schema().fields:
            raw = F.col(f"`{f.name}`") if f.name in given else F.lit(None)
            plain = not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
            value = raw.try_cast(f.dataType) if plain else raw.cast(f.dataType)
            out.append(value.alias(f.name))
            faults.append(F.when(raw.isNotNull() & value.isNull(), f"type:{f.name}"))
            if f.name not in self.optional:
                faults.append(F.when(raw.isNull(), f"missing:{f.name}"))
            if f.name in self.values:
                faults.append(F.when(~value.isin(*self.values[f.name]), f"value:{f.name}"))
        shaped = df.select(*out, F.array_compact(F.array(*faults)).alias("_faults"))
        broken = [F.when(~F.coalesce(F.expr(sql), F.lit(True)), f"rule:{n}") for n, sql in self.rules]
        every = F.array_union(F.col("_faults"), F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
        return shaped.withColumns({"contract_version": F.lit(VERSION), "violations": F.array_sort(every)}).drop("_faults")

    def documents(self, df: DataFrame) -> DataFrame:
        """Sound records as JSON texts."""
        names = [f.name for f in self.schema().fields]
        return self.conform(df).where(F.size("violations") == 0).select(F.to_json(F.struct(*names, "contract_version"), {"ignoreNullFields": "false"}).alias("document"))


BINDINGS = Contract("website_binding", "account_id string, website string, status string, confidence string, entity_class string, reason_codes array<string>", ("website",), {"status": BINDING, "confidence": CONFIDENCE})
UNITS = Contract("sellable_unit", "account_id string, surviving_account_id string, lifecycle string, relationship_type string, confidence string, standalone_score_eligible boolean", (), {"lifecycle": LIFECYCLE, "confidence": CONFIDENCE})
LANES = Contract("lane_decision", "account_id string, lane string, subtype string, eligible_for_value boolean, confidence string", (), {"lane": LANE, "confidence": CONFIDENCE})
DECISIONS = Contract(
    "account_decision", "account_id string, binding_status string, lifecycle string, lane string, operation string, accepted boolean, point double, low double, high double, confidence string", ("point", "low", "high"),
    {"binding_status": BINDING, "lifecycle": LIFECYCLE, "lane": LANE, "operation": OPERATION, "confidence": CONFIDENCE},
    (("accepted_has_value", "NOT accepted OR (point IS NOT NULL AND low IS NOT NULL AND high IS NOT NULL)"), ("interval", "low <= point AND point <= high"), ("accepted_publishes", "accepted = (operation = 'publish_value')")),
)
