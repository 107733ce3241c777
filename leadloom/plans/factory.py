"""Signals to routed leads as one lazy plan."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from leadloom.config import Scoring
from leadloom.operators import factory as f
from leadloom.session import staged


class FactoryPlan:
    """The lead factory over a signals frame."""

    def __init__(self, signals: DataFrame, as_of: str, cfg: Scoring = Scoring()):
        self.signals, self.as_of, self.cfg = signals, as_of, cfg

    @cached_property
    def evidenced(self) -> DataFrame:
        """Signals with identity and evidence columns, written once.

        All stages in one projection would make a generated method too large to compile; and the
        leads, the deduplication and the quality report all start from here.
        """
        return staged(f.with_evidence(f.with_identity(self.signals), self.as_of, self.cfg), "evidenced")

    @cached_property
    def wide(self) -> DataFrame:
        return f.with_class(f.with_fit(self.evidenced, self.cfg), self.cfg)

    @cached_property
    def hypotheses(self) -> DataFrame:
        return f.identity_hypotheses(f.with_identity(self.signals))

    @cached_property
    def evidence(self) -> DataFrame:
        return f.evidence(self.evidenced)

    @cached_property
    def fits(self) -> DataFrame:
        return f.fit_scores(self.wide)

    @cached_property
    def classes(self) -> DataFrame:
        return f.classify_leads(self.wide)

    @cached_property
    def created(self) -> DataFrame:
        return f.create_leads(self.wide, self.cfg)

    @cached_property
    def leads(self) -> DataFrame:
        return f.dedup_leads(self.created)

    @cached_property
    def routed(self) -> DataFrame:
        return f.route_leads(self.leads)

    @cached_property
    def quality(self) -> DataFrame:
        return f.pipeline_quality(self.signals, self.hypotheses, self.evidence, self.classes, self.leads)
