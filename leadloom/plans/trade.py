"""From shipments to switch leads, as one lazy plan."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.operators import enrich, health, switch, trade
from leadloom.session import staged


class TradePlan:
    """The trade pipeline over one set of inputs.

    The monthly table is much smaller than the shipments and everything later reads it, so it and
    the relationship, month and opportunity tables are written once (``staged``) and not recomputed.
    """

    def __init__(self, inputs, as_of: str):
        self.inputs, self.as_of = inputs, as_of

    @cached_property
    def monthly(self) -> DataFrame:
        return staged(trade.monthly_trade(self.inputs.shipments, self.as_of), "monthly")

    @cached_property
    def rels(self) -> DataFrame:
        return staged(trade.trade_relationships(self.monthly), "relationships")

    @cached_property
    def snapshots(self) -> DataFrame:
        return staged(trade.trade_snapshots(self.monthly), "snapshots")

    @cached_property
    def partners(self) -> DataFrame:
        i = self.inputs
        return trade.relationships_from_partners(i.import_partner, i.imported_hs, i.company_list, self.as_of)

    @cached_property
    def crossmatch(self) -> DataFrame:
        i = self.inputs
        return trade.relationships_from_codes(i.company_list, i.imported_hs, i.exported_hs, self.as_of)

    @cached_property
    def all_relationships(self) -> DataFrame:
        return trade.union_trade_sources(self.rels, self.partners, self.crossmatch)

    @cached_property
    def rules(self) -> DataFrame:
        return health.stress_rules(self.rels, self.snapshots, self.as_of)

    @cached_property
    def anomalies(self) -> DataFrame:
        return health.anomaly_statistical(health.series_features(self.snapshots))

    @cached_property
    def health(self) -> DataFrame:
        return staged(health.health_status(self.anomalies), "health")

    @cached_property
    def reasons(self) -> DataFrame:
        return health.stress_reason(self.health, self.rels, self.as_of)

    @cached_property
    def scored_health(self) -> DataFrame:
        """Relationships with their score where the model saw anything unusual, and hand-set marks."""
        seen = self.health.where("anomaly_score > 0").select("rel_id", "anomaly_score", "health_score")
        return self.rels.join(seen, "rel_id", "left").withColumn(
            "score_override", F.col("total_shipments") % 5 == 0)

    @cached_property
    def external(self) -> DataFrame:
        return trade.apply_external_health(self.scored_health, self.inputs.external_health)

    @cached_property
    def opportunities(self) -> DataFrame:
        rules = switch.opportunities_from_rules(self.rules, self.as_of)
        return rules.unionByName(switch.opportunities_from_model(self.reasons, self.rels, self.as_of))

    @cached_property
    def scored(self) -> DataFrame:
        return staged(switch.score_opportunities(self.opportunities), "scored")

    @cached_property
    def features(self) -> DataFrame:
        return switch.relationship_features(self.rels, self.snapshots, self.inputs.firms, self.health, self.as_of)

    @cached_property
    def candidates(self) -> DataFrame:
        i = self.inputs
        return staged(switch.candidate_suppliers(
            self.rels, self.snapshots, i.firms, i.people_links, self.as_of), "candidates")

    @cached_property
    def matches(self) -> DataFrame:
        return staged(switch.match_suppliers(
            self.scored, self.candidates, self.rels, self.inputs.buyer_countries), "matches")

    @cached_property
    def buyer_contacts(self) -> DataFrame:
        return switch.decision_maker_of(self.inputs.people, self.inputs.people_links)

    @cached_property
    def matched_leads(self) -> DataFrame:
        return switch.switch_leads_matched(self.scored, self.matches, self.buyer_contacts)

    @cached_property
    def unmatched_leads(self) -> DataFrame:
        """Sourcing leads when only rule-detected opportunities have been matched so far."""
        by_rule = self.scored.where("detection_method = 'rule_based'").select("opportunity_id")
        matched = self.matches.join(by_rule, "opportunity_id", "left_semi")
        return switch.switch_leads_unmatched(self.scored, matched, self.health, self.buyer_contacts)

    @cached_property
    def at_risk(self) -> DataFrame:
        """Which buyers are about to leave which supplier, and why: most likely first."""
        open_ones = switch.score_opportunities(switch.opportunities_from_rules(self.rules, self.as_of))
        return open_ones.where("status = 'open'").select(
            "opportunity_id", "buyer_name", "existing_supplier_name", "hs_code", "stress_reason", "stress_score",
            "switch_probability", "buyer_monthly_volume").orderBy(
            F.desc("switch_probability"), F.desc("buyer_monthly_volume"), "opportunity_id")


class OrgPlan:
    """Outside reports onto organisations."""

    def __init__(self, inputs):
        self.inputs = inputs

    @cached_property
    def people(self) -> DataFrame:
        return enrich.contacts(self.inputs.contact_rows)

    @cached_property
    def intent(self) -> DataFrame:
        return enrich.intent_per_company(self.inputs.intent_rows)

    @cached_property
    def news(self) -> DataFrame:
        return enrich.news_flags(self.inputs.news_rows, self.inputs.scoop_rows)
