"""All datasets of one measurement year, composed lazily from the raw tables."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame

from cohortry.operators import claims, conditions, cost, gaps, providers, risk, staging
from cohortry.session import materialize
from cohortry.sources.readers import RawTables
from cohortry.vocabulary import MIN_ATTRIBUTED_MEMBERS


class Datasets:
    """Named datasets over one set of raw tables.

    Staging and intermediate datasets stay lazy and are inlined into their readers. ``shared_*``
    datasets are read by several branches of one query and are written once. A build that has
    written a dataset itself assigns it, and later datasets read what was written.
    """

    def __init__(self, raw: RawTables, year: int, as_of: str | dt.date):
        self.raw = raw
        self.year = year
        self.as_of = as_of

    # Staging

    @cached_property
    def stg_members(self) -> DataFrame:
        return staging.stg_members(self.raw.patients, self.year)

    @cached_property
    def stg_encounters(self) -> DataFrame:
        return staging.stg_encounters(self.raw.encounters)

    @cached_property
    def stg_conditions(self) -> DataFrame:
        return staging.stg_conditions(self.raw.conditions)

    @cached_property
    def stg_procedures(self) -> DataFrame:
        return staging.stg_procedures(self.raw.procedures)

    @cached_property
    def stg_medications(self) -> DataFrame:
        return staging.stg_medications(self.raw.medications)

    # Intermediate

    @cached_property
    def int_claims_unioned(self) -> DataFrame:
        return claims.int_claims_unioned(self.stg_encounters, self.stg_conditions, self.stg_procedures)

    @cached_property
    def claim_panel(self) -> DataFrame:
        return claims.claim_panel(self.stg_encounters, self.stg_conditions, self.stg_procedures)

    @cached_property
    def int_dx_code_flags(self) -> DataFrame:
        return conditions.int_dx_code_flags(self.stg_conditions, self.raw.condition_map)

    @cached_property
    def int_member_condition_summary(self) -> DataFrame:
        return conditions.int_member_condition_summary(self.int_dx_code_flags)

    @cached_property
    def int_member_chronic_flags(self) -> DataFrame:
        return conditions.int_member_chronic_flags(self.int_member_condition_summary)

    @cached_property
    def encounter_util(self) -> DataFrame:
        return risk.encounter_util(self.stg_encounters)

    @cached_property
    def med_summary(self) -> DataFrame:
        return risk.med_summary(self.stg_medications)

    # Marts

    @cached_property
    def mart_member_risk_profile(self) -> DataFrame:
        return risk.mart_member_risk_profile(
            self.stg_members, self.int_member_chronic_flags, self.encounter_util, self.med_summary, self.as_of
        )

    @cached_property
    def mart_care_gaps(self) -> DataFrame:
        return gaps.mart_care_gaps(self.mart_member_risk_profile, self.stg_procedures, self.stg_encounters)

    @cached_property
    def mart_cost_utilization(self) -> DataFrame:
        return cost.mart_cost_utilization(self.mart_member_risk_profile)

    @cached_property
    def provider_assembled(self) -> DataFrame:
        """Scorecard rows before the quadrants.

        The profile feeds the averages and the gaps, and the claim panel feeds three branches, so both
        are written first; each branch then reads only the columns it needs.
        """
        panel = self.shared_panel
        return providers.provider_assembled(
            providers.primary_provider(panel),
            self.shared_profile,
            providers.provider_spend(panel),
            providers.gap_closure_by_member(self.shared_gaps),
            providers.provider_top_condition(self.int_dx_code_flags, panel),
        )

    def mart_provider_efficiency(self, min_members: int = MIN_ATTRIBUTED_MEMBERS) -> DataFrame:
        return providers.mart_provider_efficiency(self.shared_assembled, min_members)

    # Written once per query

    @cached_property
    def shared_profile(self) -> DataFrame:
        return materialize(self.mart_member_risk_profile, "profile")

    @cached_property
    def shared_gaps(self) -> DataFrame:
        """Gaps of the written profile; they have one reader, so they are not written themselves."""
        return gaps.mart_care_gaps(self.shared_profile, self.stg_procedures, self.stg_encounters)

    @cached_property
    def shared_panel(self) -> DataFrame:
        return materialize(providers.billable_claims(self.claim_panel), "panel")

    @cached_property
    def shared_assembled(self) -> DataFrame:
        return materialize(self.provider_assembled, "assembled")
