"""The gated build: raw tables to marts, layer by layer, with an audit trail."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import claims, providers, quality, staging
from cohortry.plans.datasets import Datasets
from cohortry.plans.sizing import Measure, TableSize, plan_stage
from cohortry.session import materialize
from cohortry.sources.readers import RawTables, read_audit_log
from cohortry.sources.writers import append_audit, write_mart


@dataclass(frozen=True)
class BuildResult:
    marts: dict[str, DataFrame]
    audit: DataFrame


STAGED = {
    "stg_members": "patients",
    "stg_encounters": "encounters",
    "stg_conditions": "conditions",
    "stg_procedures": "procedures",
    "stg_medications": "medications",
}
"""Staging tables and the raw tables they come from."""


@dataclass(frozen=True)
class Staged:
    """A written staging table, its size, and the results of its own checks and of the raw table's."""

    rows: DataFrame
    size: TableSize
    raw_results: list[tuple]
    results: list[tuple]


def unique_results(table: DataFrame, checks: list[quality.Check], columns: dict[str, Column] | None = None) -> list[tuple]:
    """Results of the unique checks of a written table, from one grouping; ``columns`` may stand in for checked ones."""
    own = [check for check in checks if check.kind == "unique"]
    if not own:
        return []
    counted = quality.duplicated_values(table, {f"c{i}": (columns or {}).get(f"{c.table}.{c.column}", F.col(c.column)) for i, c in enumerate(own)}).first()
    return [(c.kind, c.table, c.column, counted[f"c{i}"], "fail" if counted[f"c{i}"] else "pass") for i, c in enumerate(own)]


def stage_table(raw: RawTables, name: str, year: int) -> Staged:
    """Stage a raw table into a scratch table in one scan, with the row-level checks of both collected on the way.

    The scratch table keeps the rows that staging leaves out, marked, and the raw table's unique columns, so that the unique
    checks of both are one grouping over it.
    """
    source = STAGED[name]
    raw_checks = [check for check in quality.RAW_CHECKS if check.table == source]
    checks = [check for check in quality.STAGING_CHECKS if check.table == name]
    on_raw, on_staged, measure = quality.RowChecks(raw_checks), quality.RowChecks(checks, F.col(staging.KEPT)), Measure()
    carried = [check.column for check in raw_checks if check.kind == "unique"]
    stage = getattr(staging, name)
    read = on_raw.on(getattr(raw, source))
    rows = stage(read, year, carried=carried) if name == "stg_members" else stage(read, carried=carried)
    written = materialize(measure.on(on_staged.on(rows)), name)
    columns = {f"{source}.{c}": F.col(staging.carried_name(c)) for c in carried}
    columns |= {f"{name}.{c.column}": F.when(F.col(staging.KEPT), F.col(c.column)) for c in checks if c.kind == "unique"}
    uniques = unique_results(written, [*raw_checks, *checks], columns)
    kept = written.where(F.col(staging.KEPT)).drop(staging.KEPT, *[staging.carried_name(c) for c in carried])
    return Staged(
        kept,
        measure.size(),
        on_raw.results() + [r for r in uniques if r[1] == source],
        on_staged.results() + [r for r in uniques if r[1] == name],
    )


def check_raw(table: DataFrame, name: str) -> list[tuple]:
    """The checks of a raw table that nothing is staged from: its checked columns are written to scratch in one scan."""
    checks = [check for check in quality.RAW_CHECKS if check.table == name]
    collector = quality.RowChecks(checks)
    columns = list(dict.fromkeys(check.column for check in checks))
    written = materialize(collector.on(table.select(*columns)), name)
    return collector.results() + unique_results(written, checks)


def build(
    spark: SparkSession,
    raw: RawTables,
    out: str,
    year: int,
    as_of: str | dt.date,
    run_id: str,
    run_timestamp: dt.datetime,
    gate: bool = True,
    max_stale_days: int = quality.MAX_STALE_DAYS,
) -> BuildResult:
    """Build all marts below ``out``, running each layer's declared checks before the next layer.

    Row-level checks are collected while a table is written, unique checks read its written keys, and each stage's
    shuffles are planned from the sizes measured in staging. With ``gate`` a failed layer stops the build. Audit rows are appended whatever their results.
    """
    data = Datasets(raw, year, as_of)

    def enforce(results: list[tuple]) -> None:
        if gate:
            quality.enforce(spark.createDataFrame(results, quality.RESULT_SCHEMA))

    # Each raw table is read once: staged, checked and measured on the way to a scratch table that later steps read.
    staged = {name: stage_table(raw, name, year) for name in STAGED}
    raw_only = check_raw(raw.providers, "providers")
    enforce([r for s in staged.values() for r in s.raw_results] + raw_only)
    enforce([r for s in staged.values() for r in s.results])
    for name, table in staged.items():
        setattr(data, name, table.rows)
    sizes = {name: table.size for name, table in staged.items()}

    # What a layer has written replaces the lazy dataset, so every later reader scans it.
    def write(base: str, name: str, df: DataFrame, checks: list[quality.Check]) -> tuple[DataFrame, list[tuple]]:
        own = [check for check in checks if check.table == name]
        collector = quality.RowChecks(own)
        written = write_mart(collector.on(df), f"{out}/{base}", name, year)
        return written, collector.results() + unique_results(written, own)

    layer: dict[str, DataFrame] = {}
    results: list[tuple] = []
    for name, stage in (("int_claims_unioned", "spine"), ("int_dx_code_flags", "chronic_flags"), ("int_member_chronic_flags", "chronic_flags")):
        plan_stage(spark, stage, sizes)
        layer[name], found = write("intermediate", name, getattr(data, name), quality.INTERMEDIATE_CHECKS)
        results += found
        setattr(data, name, layer[name])
    enforce(results)

    marts: dict[str, DataFrame] = {}
    results = []

    def write_checked(name: str, mart: DataFrame) -> DataFrame:
        marts[name], found = write("marts", name, mart, quality.MART_CHECKS)
        results.extend(found)
        return marts[name]

    plan_stage(spark, "risk_profile", sizes)
    profile = write_checked("mart_member_risk_profile", data.mart_member_risk_profile)
    data.mart_member_risk_profile = data.shared_profile = profile
    plan_stage(spark, "care_gaps", sizes)
    data.shared_gaps = write_checked("mart_care_gaps", data.mart_care_gaps)
    write_checked("mart_cost_utilization", data.mart_cost_utilization)
    plan_stage(spark, "providers", sizes)
    panel = providers.billable_claims(claims.panel_of_spine(layer["int_claims_unioned"]))
    data.shared_panel = write_mart(panel, f"{out}/intermediate", "claim_panel")
    data.shared_assembled = write_mart(data.provider_assembled, f"{out}/intermediate", "provider_assembled")
    write_checked("mart_provider_efficiency", data.mart_provider_efficiency().withColumn("measurement_year", F.lit(year)))

    audit = audit_run(spark, marts, data.stg_encounters, f"{out}/audit", as_of, run_id, run_timestamp, max_stale_days)
    enforce(results)
    if gate:
        quality.enforce(audit)
    return BuildResult(marts, audit)


def audit_run(
    spark: SparkSession,
    marts: dict[str, DataFrame],
    encounters: DataFrame,
    path: str,
    as_of: str | dt.date,
    run_id: str,
    run_timestamp: dt.datetime,
    max_stale_days: int = quality.MAX_STALE_DAYS,
) -> DataFrame:
    """Run the post-build checks, append their results to the log and return this run's rows."""
    prior = quality.prior_run_counts(read_audit_log(spark, path))
    rows = quality.audit_rows(
        run_timestamp,
        run_id,
        quality.row_count_drop(quality.row_counts(marts), prior),
        [quality.null_rates(mart, marts[mart], columns) for mart, columns in quality.NULL_RATE_COLUMNS.items()],
        quality.freshness("stg_encounters", encounters, "service_date", as_of, max_stale_days),
    )
    append_audit(rows, path)
    log = read_audit_log(spark, path)
    return log.where((log["run_id"] == run_id) & (log["run_date"] == run_timestamp.date())).drop("_inserted_at", "run_date")
