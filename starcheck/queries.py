"""Registered queries: every dataset, check and report over the whole driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.functions.codes import code_in, code_in_range, condition_flag
from cohortry.operators import claims, codes, conditions, gaps, providers, quality, reports, risk
from cohortry.plans.datasets import Datasets
from cohortry.schemas import CONDITIONS, RAW_TABLES
from cohortry.session import configure, delete_scratch, materialize, owned, scratch_path
from cohortry.sources.footers import stored_counts, stored_freshness
from cohortry.sources.published import publish
from cohortry.sources.readers import StoredMarts, read_rejected, read_table
from cohortry.sources.writers import load_csv, write_mart
from cohortry.vocabulary import SERVICE_CODES
from starcheck import bind
from starcheck.bind import AS_OF, YEAR

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

CODE_RANGES = [
    ("1", "15", "tens"),
    ("17", "23", "late tens and twenties"),
    ("2", "29", "twenties"),
    ("60", "63", "sixties"),
    ("8", "99", "high"),
]


def comparable(df: DataFrame) -> DataFrame:
    """Only bigint, double, boolean and text columns, so both engines return equal values."""

    def plain(name: str, kind: str) -> str:
        if kind.startswith("decimal"):
            return "double"
        if kind in ("date", "timestamp"):
            return "string"
        return "bigint" if kind == "int" else kind

    return df.select(*[F.col(name).cast(plain(name, kind)).alias(name) for name, kind in df.dtypes])


def registered(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(configure(spark), sf_dir))

    REGISTRY[build.__name__] = run
    return build


def dataset(build: Callable[[Datasets], DataFrame]) -> Callable[[Datasets], DataFrame]:
    """Register a query that needs nothing but the datasets."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(bind.datasets(spark, sf_dir)))

    REGISTRY[build.__name__] = run
    return build


# Staging


@registered
def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnoses written as CSV with quoted line breaks, and some again with a field too many, loaded in one pass and read back."""
    folder = scratch_path(spark, "ingest")
    noted = F.concat("DESCRIPTION", F.lit('\nsays "'), "CODE", F.lit('"'))
    landed = bind.conditions(spark, sf_dir).withColumn("DESCRIPTION", noted)
    # Another order than the declared one, and a column that is not declared.
    landed = landed.select(F.concat(F.lit("n"), "CODE").alias("NOTE"), *reversed(landed.columns))
    landed.write.option("header", True).option("escape", '"').csv(f"{folder}/landed")
    # Lines of a file of their own: the first of each task carries the header.
    longer = landed.where(F.col("CODE").endswith("7")).withColumn("DESCRIPTION", F.split("DESCRIPTION", "\n")[0])
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in landed.columns]
    first_of_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.when(first_of_task, ",".join(landed.columns) + "\n").otherwise("")
    lines = longer.select(F.concat(header, F.concat_ws(",", *fields, F.lit("surplus"))).alias("value"))
    lines.write.mode("append").text(f"{folder}/landed")
    load_csv(spark, f"{folder}/landed", CONDITIONS, folder, "conditions", max_rejected=1 << 62)
    good = read_table(spark, folder, "conditions").withColumn("misfits", F.lit(None).cast("string"))
    set_aside = read_rejected(spark, folder, "conditions").drop("_record").withColumnRenamed("_misfits", "misfits")
    return owned(comparable(good).unionByName(set_aside), folder)


@dataset
def condition_map_scan(d: Datasets) -> DataFrame:
    return conditions.condition_map_usage(d.raw.condition_map, d.stg_conditions)


@dataset
def stg_members(d: Datasets) -> DataFrame:
    return d.stg_members


@dataset
def stg_encounters(d: Datasets) -> DataFrame:
    return d.stg_encounters


@dataset
def stg_conditions(d: Datasets) -> DataFrame:
    return d.stg_conditions


@dataset
def stg_procedures(d: Datasets) -> DataFrame:
    return d.stg_procedures


@dataset
def stg_medications(d: Datasets) -> DataFrame:
    return d.stg_medications


@dataset
def surrogate_keys(d: Datasets) -> DataFrame:
    def keys(df: DataFrame, source: str, key: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), "member_id", F.col(key).alias("row_key"))

    return (
        keys(d.stg_conditions, "condition", "condition_id")
        .unionByName(keys(d.stg_procedures, "procedure", "procedure_id"))
        .unionByName(keys(d.stg_medications, "medication", "rx_id"))
    )


# Intermediate


@dataset
def claims_dx_lines(d: Datasets) -> DataFrame:
    return claims.claims_dx_lines(d.stg_conditions, d.stg_encounters)


@dataset
def claims_procedure_lines(d: Datasets) -> DataFrame:
    return claims.claims_procedure_lines(d.stg_procedures, d.stg_encounters)


@dataset
def int_claims_unioned(d: Datasets) -> DataFrame:
    return d.int_claims_unioned


@dataset
def int_dx_code_flags(d: Datasets) -> DataFrame:
    return d.int_dx_code_flags


@dataset
def int_member_condition_summary(d: Datasets) -> DataFrame:
    return d.int_member_condition_summary


@dataset
def int_member_chronic_flags(d: Datasets) -> DataFrame:
    return d.int_member_chronic_flags


# Risk and cost


@dataset
def encounter_util(d: Datasets) -> DataFrame:
    return d.encounter_util


@dataset
def med_summary(d: Datasets) -> DataFrame:
    return d.med_summary


@dataset
def member_pmpm(d: Datasets) -> DataFrame:
    return risk.member_pmpm(d.stg_members, AS_OF)


@dataset
def risk_tier_assignment(d: Datasets) -> DataFrame:
    return d.mart_member_risk_profile.select(
        "member_id",
        "hcc_risk_score",
        "ip_admit_count",
        "er_visit_count",
        "cc_cancer",
        "condition_count",
        "cost_pmpm",
        "risk_tier",
    )


@dataset
def mart_member_risk_profile(d: Datasets) -> DataFrame:
    return d.mart_member_risk_profile


@dataset
def mart_cost_utilization(d: Datasets) -> DataFrame:
    return d.mart_cost_utilization


# Care gaps


@dataset
def polypharmacy_members(d: Datasets) -> DataFrame:
    return gaps.polypharmacy_members(d.med_summary)


@dataset
def care_gap_services(d: Datasets) -> DataFrame:
    return gaps.care_gap_services(d.mart_member_risk_profile, d.stg_procedures)


@dataset
def readmission_flags(d: Datasets) -> DataFrame:
    return gaps.readmission_flags(d.stg_encounters)


@dataset
def mart_care_gaps(d: Datasets) -> DataFrame:
    return d.mart_care_gaps


@dataset
def mart_care_gaps_within_year(d: Datasets) -> DataFrame:
    return gaps.mart_care_gaps(
        d.mart_member_risk_profile, d.stg_procedures, d.stg_encounters, year=YEAR, inpatient_only=True
    )


# Providers


@dataset
def primary_provider(d: Datasets) -> DataFrame:
    return providers.primary_provider(d.claim_panel)


@dataset
def provider_spend(d: Datasets) -> DataFrame:
    return providers.provider_spend(d.claim_panel)


@dataset
def provider_top_condition(d: Datasets) -> DataFrame:
    return providers.provider_top_condition(d.int_dx_code_flags, d.claim_panel)


@dataset
def gap_closure_by_member(d: Datasets) -> DataFrame:
    return providers.gap_closure_by_member(d.mart_care_gaps)


@dataset
def provider_assembled(d: Datasets) -> DataFrame:
    return d.provider_assembled


@dataset
def provider_quadrants(d: Datasets) -> DataFrame:
    return providers.provider_quadrants(d.shared_assembled)


@dataset
def mart_provider_efficiency(d: Datasets) -> DataFrame:
    return d.mart_provider_efficiency()


@dataset
def mart_provider_efficiency_min42(d: Datasets) -> DataFrame:
    return d.mart_provider_efficiency(min_members=42)


# Codes


@dataset
def code_range_filter(d: Datasets) -> DataFrame:
    exact = code_in_range("snomed_code", "11", "13")
    wider = code_in_range("snomed_code", "11", "13", include_subcodes=True)
    return d.stg_conditions.where(wider).select(
        "condition_id", "member_id", "snomed_code", exact.alias("within_exact_range")
    )


@dataset
def code_set_filter(d: Datasets) -> DataFrame:
    return d.stg_procedures.where(code_in("snomed_code", SERVICE_CODES["eye_exam"][0])).select(
        "procedure_id", "member_id", "snomed_code", "procedure_date"
    )


@dataset
def condition_flag_agg(d: Datasets) -> DataFrame:
    return d.int_dx_code_flags.groupBy("member_id").agg(
        condition_flag("diabetes_t2").alias("has_diabetes"), condition_flag("chf").alias("has_chf")
    )


@registered
def code_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(str(row) for row in CODE_RANGES)
    ranges = spark.sql(f"select * from values {values} as ranges(low_code, high_code, range_label)")
    diagnoses = bind.datasets(spark, sf_dir).stg_conditions.select("condition_id", "member_id", "snomed_code")
    return codes.code_range_join(diagnoses, ranges, "snomed_code")


@registered
def wide_codes_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [f"code_{n}" for n in range(1, 8)]
    code = F.expr("case when l_partkey % 11 = 0 then '' else cast(l_partkey % 200 as string) end")
    # Line numbers repeat within an order: every repeat opens a further claim row, so each line keeps a cell of its own.
    again = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    lines = bind.star(spark, sf_dir, "lineitem").withColumn("claim_row", F.row_number().over(again))
    wide = lines.groupBy(F.col("l_orderkey").alias("claim_id"), "claim_row").agg(
        *[F.max(F.when(F.col("l_linenumber") == n, code)).alias(f"code_{n}") for n in range(1, 8)]
    )
    return codes.wide_codes_to_long(wide, ["claim_id", "claim_row"], columns).drop("claim_row")


# Quality


def _marts(d: Datasets) -> dict[str, DataFrame]:
    """The marts as written tables, which is what the checks read after a build."""
    d.mart_member_risk_profile = d.shared_profile
    d.shared_gaps = materialize(d.mart_care_gaps, "gaps")
    return {
        "mart_member_risk_profile": d.shared_profile,
        "mart_care_gaps": d.shared_gaps,
        "mart_cost_utilization": d.mart_cost_utilization,
        "mart_provider_efficiency": materialize(d.mart_provider_efficiency(), "efficiency"),
    }


def _suite(d: Datasets, kind: str) -> DataFrame:
    # Tables that a build has on disk; here each is the result of a join, and five datasets read them.
    d.raw.conditions = materialize(d.raw.conditions, "conditions")
    d.raw.procedures = materialize(d.raw.procedures, "procedures")
    tables = {
        **d.raw.as_dict(),
        "stg_members": d.stg_members,
        "stg_encounters": d.stg_encounters,
        "stg_conditions": d.stg_conditions,
        "stg_procedures": d.stg_procedures,
        "stg_medications": d.stg_medications,
        "int_claims_unioned": d.int_claims_unioned,
        "int_dx_code_flags": d.int_dx_code_flags,
        "int_member_chronic_flags": d.int_member_chronic_flags,
        **_marts(d),
    }
    return quality.run_checks(tables, [check for check in quality.DEFAULT_SUITE if check.kind == kind])


@dataset
def dq_unique(d: Datasets) -> DataFrame:
    return _suite(d, "unique")


@dataset
def dq_not_null(d: Datasets) -> DataFrame:
    return _suite(d, "not_null")


@dataset
def dq_accepted_values(d: Datasets) -> DataFrame:
    return _suite(d, "accepted_values")


@dataset
def dq_accepted_range(d: Datasets) -> DataFrame:
    return _suite(d, "accepted_range")


@dataset
def dq_duplicate_keys(d: Datasets) -> DataFrame:
    key = ["PATIENT", "CODE", "START", "ENCOUNTER", "STOP", "TOTALCOST", "PAYER", "BASE_COST"]
    return quality.duplicate_groups(d.raw.medications, [key[:3], key[:4], key[:6], key])


@registered
def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts({table: bind.star(spark, sf_dir, table) for table in bind.STAR_SCHEMAS})


def _audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit log with one run per order day: order counts by priority, and a null-rate row per run."""
    daily = bind.star(spark, sf_dir, "orders").groupBy(
        F.col("o_orderdate").cast("date").alias("run_date"), F.col("o_orderpriority").alias("priority")
    )
    counts = daily.agg(F.count("*").alias("row_count"))
    run = F.expr("cast(run_date as timestamp)").alias("run_timestamp")
    row_count_rows = counts.select(
        run,
        F.concat(F.lit("run-"), F.col("run_date").cast("string")).alias("run_id"),
        F.lit("row_count").alias("check_type"),
        F.concat(F.lit("orders_"), F.substring("priority", 1, 1)).alias("table_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit("pass").alias("check_result"),
        "row_count",
        F.lit(None).cast("double").alias("null_rate_pct"),
        "run_date",
    )
    null_rate_rows = counts.groupBy("run_date").agg(F.count("*").alias("tables")).select(
        run,
        F.concat(F.lit("run-"), F.col("run_date").cast("string")).alias("run_id"),
        F.lit("null_rate").alias("check_type"),
        F.lit("orders").alias("table_name"),
        F.lit("o_custkey").alias("column_name"),
        F.lit("pass").alias("check_result"),
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(0.0).alias("null_rate_pct"),
        "run_date",
    )
    return row_count_rows.unionByName(null_rate_rows)


@registered
def dq_prior_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.prior_run_counts(_audit_history(spark, sf_dir))


@registered
def dq_row_count_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority of the latest day against the run of the day before, and a table never logged."""
    history = _audit_history(spark, sf_dir)
    latest = F.broadcast(history.agg(F.max("run_timestamp").alias("latest")))
    dated = history.where("check_type = 'row_count'").crossJoin(latest)
    current = dated.where("run_timestamp = latest").select("table_name", "row_count")
    never_logged = bind.star(spark, sf_dir, "lineitem").agg(F.count("*").alias("row_count"))
    current = current.unionByName(never_logged.withColumn("table_name", F.lit("lineitem")))
    before = history.crossJoin(latest).where("run_timestamp < latest").drop("latest")
    return quality.row_count_drop(current, quality.prior_run_counts(before))


@dataset
def dq_null_rates(d: Datasets) -> DataFrame:
    marts = _marts(d)
    rates = [quality.null_rates(mart, marts[mart], columns) for mart, columns in quality.NULL_RATE_COLUMNS.items()]
    rates.append(quality.null_rates("stg_encounters", d.stg_encounters, ["provider_id", "reason_snomed_code"]))
    return quality.union_all(rates)


@dataset
def dq_freshness(d: Datasets) -> DataFrame:
    return quality.freshness("stg_encounters", d.stg_encounters, "service_date", AS_OF).unionByName(
        quality.freshness("stg_procedures", d.stg_procedures, "procedure_date", AS_OF, max_days=60)
    )


@registered
def dq_stored_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness and row counts of published tables, from their footers and manifests."""
    d, folder = bind.datasets(spark, sf_dir), scratch_path(spark, "stored")
    publish(d.stg_encounters, f"{folder}/stg_encounters", "service_year")
    publish(d.stg_procedures, f"{folder}/stg_procedures")
    fresh = stored_freshness(spark, f"{folder}/stg_encounters", "stg_encounters", "service_date", AS_OF).unionByName(
        stored_freshness(spark, f"{folder}/stg_procedures", "stg_procedures", "procedure_date", AS_OF, max_days=60)
    )
    counts = stored_counts(spark, {name: f"{folder}/{name}" for name in ("stg_encounters", "stg_procedures")})
    done = fresh.join(F.broadcast(counts), "table_name")  # two rows
    delete_scratch(spark, folder)
    return done


@dataset
def dq_schema_contract(d: Datasets) -> DataFrame:
    raw = d.raw.as_dict()
    return quality.union_all([quality.schema_contract(name, raw[name], schema) for name, schema in RAW_TABLES.items()])


@dataset
def dq_audit_rows(d: Datasets) -> DataFrame:
    marts = _marts(d)
    # A prior run for every mart: other tables' counts stand in for what it logged.
    prior = {
        "mart_member_risk_profile": d.stg_encounters,
        "mart_care_gaps": d.stg_procedures,
        "mart_cost_utilization": d.stg_encounters.select("claim_type").distinct(),
        "mart_provider_efficiency": d.raw.providers,
    }
    drops = quality.row_count_drop(quality.row_counts(marts), quality.row_counts(prior))
    nulls = [quality.null_rates(mart, marts[mart], columns) for mart, columns in quality.NULL_RATE_COLUMNS.items()]
    fresh = quality.freshness("stg_encounters", d.stg_encounters, "service_date", AS_OF)
    return quality.audit_rows(dt.datetime(2001, 12, 31, 6, 0, 0), "run-2001", drops, nulls, fresh)


@registered
def audit_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unexpired(_audit_history(spark, sf_dir), AS_OF)


# Reports


@dataset
def report_population_kpis(d: Datasets) -> DataFrame:
    return reports.report_population_kpis(d.mart_member_risk_profile, YEAR)


@dataset
def report_tier_distribution(d: Datasets) -> DataFrame:
    return reports.report_tier_distribution(d.mart_member_risk_profile, YEAR)


@dataset
def report_top_conditions(d: Datasets) -> DataFrame:
    return reports.report_top_conditions(d.mart_member_risk_profile, YEAR)


@dataset
def report_hcc_box(d: Datasets) -> DataFrame:
    return reports.report_hcc_box(d.shared_profile, YEAR)


def _gaps_with_tier(d: Datasets) -> DataFrame:
    return reports.report_gaps_with_tier(d.shared_gaps, d.shared_profile, YEAR)


@dataset
def report_claim_cost_box(d: Datasets) -> DataFrame:
    return reports.report_claim_cost_box(d.stg_encounters)


@dataset
def report_gaps_with_tier(d: Datasets) -> DataFrame:
    return _gaps_with_tier(d)


@dataset
def report_gap_kpis(d: Datasets) -> DataFrame:
    return reports.report_gap_kpis(_gaps_with_tier(d))


@dataset
def report_gap_rate_by_tier(d: Datasets) -> DataFrame:
    return reports.report_gap_rate_by_tier(_gaps_with_tier(d))


@dataset
def report_gap_summary(d: Datasets) -> DataFrame:
    return reports.report_gap_summary(_gaps_with_tier(d))


@dataset
def report_gap_heatmap(d: Datasets) -> DataFrame:
    return reports.report_gap_heatmap(_gaps_with_tier(d))


@dataset
def report_cost_kpis(d: Datasets) -> DataFrame:
    return reports.report_cost_kpis(d.mart_cost_utilization, YEAR)


@dataset
def report_cost_by_tier(d: Datasets) -> DataFrame:
    return reports.report_cost_by_tier(d.mart_cost_utilization, YEAR)


@registered
def report_stored_cost_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost per tier of the year before, read from the published mart, which holds two years."""
    folder, raw = scratch_path(spark, "marts"), bind.raw_tables(spark, sf_dir)
    for year in (YEAR - 1, YEAR):
        write_mart(Datasets(raw, year, f"{year}-12-31").mart_cost_utilization, folder, "mart_cost_utilization", year)
    return owned(reports.report_cost_by_tier(StoredMarts(spark, folder).mart("mart_cost_utilization", YEAR - 1), YEAR - 1), folder)


@dataset
def report_utilization_by_tier(d: Datasets) -> DataFrame:
    return reports.report_utilization_by_tier(d.mart_cost_utilization, YEAR)


@dataset
def report_member_sample(d: Datasets) -> DataFrame:
    return reports.report_member_sample(d.mart_member_risk_profile, YEAR)


@dataset
def report_key_insight(d: Datasets) -> DataFrame:
    return reports.report_key_insight(d.mart_cost_utilization, YEAR)


@dataset
def report_top_providers(d: Datasets) -> DataFrame:
    return reports.report_top_providers(d.mart_provider_efficiency())


@dataset
def report_provider_kpis(d: Datasets) -> DataFrame:
    return reports.report_provider_kpis(d.mart_provider_efficiency())


@dataset
def report_provider_quadrant_points(d: Datasets) -> DataFrame:
    written = materialize(d.mart_provider_efficiency(), "efficiency")
    return reports.report_provider_quadrant_points(written)


@dataset
def report_provider_scorecard(d: Datasets) -> DataFrame:
    return reports.report_provider_scorecard(d.mart_provider_efficiency())
