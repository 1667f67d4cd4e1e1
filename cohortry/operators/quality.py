"""Data-quality checks. Every check is a lazy DataFrame; column checks of a table share one scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.functions.dates import as_date
from cohortry.functions.keys import packed_key
from cohortry.functions.numeric import ratio
from cohortry.schemas import AUDIT_LOG
from cohortry.vocabulary import CLAIM_TYPES, GAP_TYPES, MIN_ATTRIBUTED_MEMBERS, QUADRANTS, RISK_TIERS, SEXES

MAX_DROP_PCT = 10
MAX_NULL_PCT = 1
MAX_STALE_DAYS = 90


class QualityError(RuntimeError):
    """A layer's checks failed; the message lists them."""


@dataclass(frozen=True)
class Check:
    """A declared column check.

    ``kind`` is unique, not_null, accepted_values or accepted_range. NULL breaks only not_null.
    """

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None


def unique(table: str, column: str) -> Check:
    return Check(table, column, "unique")


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, column, "not_null") for column in columns]


def accepted_values(table: str, column: str, values: Sequence[str]) -> Check:
    return Check(table, column, "accepted_values", values=tuple(values))


def accepted_range(table: str, column: str, low: float, high: float | None = None) -> Check:
    return Check(table, column, "accepted_range", low=low, high=high)


# The declared checks of each layer.
RAW_CHECKS = [
    unique("patients", "Id"),
    *not_null("patients", "Id", "BIRTHDATE", "GENDER"),
    unique("encounters", "Id"),
    *not_null("encounters", "Id", "PATIENT", "START"),
    *not_null("conditions", "PATIENT", "CODE"),
    *not_null("procedures", "PATIENT"),
    *not_null("medications", "PATIENT"),
    unique("providers", "Id"),
    *not_null("providers", "Id"),
]

STAGING_CHECKS = [
    unique("stg_members", "member_id"),
    *not_null("stg_members", "member_id", "measurement_year"),
    accepted_values("stg_members", "sex", SEXES),
    accepted_range("stg_members", "total_healthcare_expenses", 0),
    unique("stg_encounters", "encounter_id"),
    *not_null("stg_encounters", "encounter_id", "member_id", "claim_type"),
    accepted_values("stg_encounters", "claim_type", CLAIM_TYPES),
    accepted_range("stg_encounters", "paid_amount", 0),
    unique("stg_conditions", "condition_id"),
    *not_null("stg_conditions", "condition_id", "member_id", "snomed_code"),
    unique("stg_procedures", "procedure_id"),
    *not_null("stg_procedures", "procedure_id", "member_id"),
    unique("stg_medications", "rx_id"),
    *not_null("stg_medications", "rx_id", "member_id"),
    accepted_range("stg_medications", "total_drug_cost", 0),
]

INTERMEDIATE_CHECKS = [
    unique("int_claims_unioned", "claims_line_id"),
    *not_null("int_claims_unioned", "claims_line_id", "member_id"),
    accepted_values("int_claims_unioned", "claim_type", CLAIM_TYPES),
    *not_null("int_dx_code_flags", "member_id", "dx_code"),
    unique("int_member_chronic_flags", "member_id"),
    *not_null("int_member_chronic_flags", "member_id"),
    accepted_range("int_member_chronic_flags", "hcc_risk_score", 0, 5),
]

MART_CHECKS = [
    unique("mart_member_risk_profile", "member_id"),
    *not_null("mart_member_risk_profile", "member_id", "measurement_year", "risk_tier", "hcc_risk_score"),
    accepted_values("mart_member_risk_profile", "risk_tier", RISK_TIERS),
    accepted_range("mart_member_risk_profile", "hcc_risk_score", 0, 5),
    accepted_range("mart_member_risk_profile", "condition_count", 0, 20),
    accepted_range("mart_member_risk_profile", "cost_pmpm", 0),
    accepted_range("mart_member_risk_profile", "total_healthcare_expenses", 0),
    unique("mart_care_gaps", "gap_id"),
    *not_null("mart_care_gaps", "gap_id", "member_id", "gap_type", "gap_open"),
    accepted_values("mart_care_gaps", "gap_type", GAP_TYPES),
    accepted_range("mart_care_gaps", "gap_open", 0, 1),
    *not_null("mart_cost_utilization", "risk_tier", "measurement_year"),
    accepted_range("mart_cost_utilization", "member_count", 1),
    accepted_range("mart_cost_utilization", "avg_cost_pmpm", 0),
    accepted_range("mart_cost_utilization", "pct_of_population", 0, 100),
    unique("mart_provider_efficiency", "provider_npi"),
    *not_null("mart_provider_efficiency", "provider_npi", "efficiency_quadrant"),
    accepted_range("mart_provider_efficiency", "attributed_member_count", MIN_ATTRIBUTED_MEMBERS),
    accepted_values("mart_provider_efficiency", "efficiency_quadrant", QUADRANTS),
]

DEFAULT_SUITE = RAW_CHECKS + STAGING_CHECKS + INTERMEDIATE_CHECKS + MART_CHECKS

# Columns whose null rate is logged for each mart.
NULL_RATE_COLUMNS = {
    "mart_member_risk_profile": ["member_id", "risk_tier", "measurement_year", "hcc_risk_score"],
    "mart_care_gaps": ["member_id", "gap_type", "gap_open", "measurement_year"],
    "mart_cost_utilization": ["risk_tier", "member_count", "avg_cost_pmpm"],
    "mart_provider_efficiency": ["provider_npi", "attributed_member_count"],
}


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Results of several checks as one DataFrame."""
    return reduce(DataFrame.unionByName, frames)


def _verdict(failed: Column) -> Column:
    return F.when(failed, "fail").otherwise("pass")


def _violates(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(*check.values)
    broken = column < check.low
    return broken if check.high is None else broken | (column > check.high)


RESULT_SCHEMA = "check_type string, table_name string, column_name string, failing bigint, check_result string"


class RowChecks:
    """Row-level checks collected while a table is written: no scan of their own.

    ``on`` puts the collector under the write; after it, ``results`` has a row per check. ``within`` limits the
    checks to some of the rows written.
    """

    def __init__(self, checks: Sequence[Check], within: Column | None = None):
        self.checks = [check for check in checks if check.kind != "unique"]
        self._within = within
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        broken = [_violates(check) if self._within is None else self._within & _violates(check) for check in self.checks]
        return df.observe(self._seen, *[F.count_if(x).alias(f"c{i}") for i, x in enumerate(broken)]) if broken else df

    def results(self) -> list[tuple[str, str, str, int, str]]:
        found = self._seen.get if self.checks else {}
        return [
            (check.kind, check.table, check.column, found[f"c{i}"], "fail" if found[f"c{i}"] else "pass") for i, check in enumerate(self.checks)
        ]


def duplicated_values(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """One row: per name, how many non-null values of the column occur more than once.

    All columns are one grouping of (column, value), so the table is read and shuffled once, however many keys it has; values are
    shuffled as ``packed_key``.
    """
    keys = [F.struct(F.lit(i).alias("no"), packed_key(column.cast("string")).alias("value")) for i, column in enumerate(columns.values())]
    stacked = df.select(F.explode(F.array(*keys)).alias("key")).select("key.*") if len(keys) > 1 else df.select(keys[0].alias("key")).select("key.*")
    counts = stacked.where(F.col("value").isNotNull()).groupBy("no", "value").agg(F.count("*").alias("occurrences"))
    return counts.agg(*[F.count_if((F.col("no") == i) & (F.col("occurrences") > 1)).alias(name) for i, name in enumerate(columns)])


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Failing rows (for unique: failing values) and verdict of every check.

    Per table, all row-level checks are one aggregation over only the checked columns, and all unique checks one grouping of
    (check, value) with map-side combine. A table that is being written is checked on the way (``RowChecks``).
    """
    results: list[DataFrame] = []
    for table in dict.fromkeys(check.table for check in checks):
        own = [check for check in checks if check.table == table]
        for unique_checks in (False, True):
            part = [check for check in own if (check.kind == "unique") == unique_checks]
            if not part:
                continue
            names = [f"c{i}" for i in range(len(part))]
            if unique_checks:
                wide = duplicated_values(tables[table], {n: F.col(check.column) for n, check in zip(names, part, strict=True)})
            else:
                wide = tables[table].agg(*[F.count_if(_violates(check)).alias(n) for n, check in zip(names, part, strict=True)])
            cells = [cell for n, check in zip(names, part, strict=True) for cell in (F.lit(check.kind), F.lit(check.column), F.col(n))]
            long = wide.select(F.stack(F.lit(len(part)), *cells).alias("check_type", "column_name", "failing"))
            results.append(long.withColumn("table_name", F.lit(table)))
    return union_all(results).select(
        "check_type", "table_name", "column_name", "failing", _verdict(F.col("failing") > 0).alias("check_result")
    )


def enforce(results: DataFrame) -> None:
    """Raise if any check failed. Reads the result rows only, one per declared check."""
    failed = results.where(F.col("check_result") == "fail").collect()
    if failed:
        lines = [f"{r['check_type']} {r['table_name']}.{r['column_name']}" for r in failed]
        raise QualityError("failed checks: " + "; ".join(sorted(lines)))


def duplicate_groups(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """For each candidate key, the number of key values that occur more than once."""

    def one(keys: Sequence[str]) -> DataFrame:
        counts = df.groupBy(*keys).agg(F.count("*").alias("occurrences"))
        return counts.agg(F.count_if(F.col("occurrences") > 1).alias("duplicate_groups")).select(
            F.lit(", ".join(keys)).alias("key_columns"), "duplicate_groups"
        )

    return union_all([one(keys) for keys in key_sets])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return union_all(
        [df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    ).select("table_name", "row_count")


def prior_run_counts(audit_log: DataFrame) -> DataFrame:
    """Row counts logged by the latest run. An empty log gives no rows."""
    latest = audit_log.agg(F.max("run_timestamp").alias("latest"))
    # One row, so the broadcast has a fixed size.
    return (
        audit_log.where(F.col("check_type") == "row_count")
        .join(F.broadcast(latest), F.col("run_timestamp") == F.col("latest"))
        .select("table_name", "row_count")
    )


def row_count_drop(current: DataFrame, prior: DataFrame, max_drop_pct: float = MAX_DROP_PCT) -> DataFrame:
    """Drop of each table against the prior run; a table without one is compared with itself."""
    before = prior.select("table_name", F.col("row_count").alias("logged_count"))
    prior_count = F.coalesce("logged_count", "row_count")
    dropped = (prior_count - F.col("row_count")) * 100
    return current.join(before, "table_name", "left").select(
        "table_name",
        "row_count",
        prior_count.alias("prior_count"),
        F.when(prior_count > 0, ratio(dropped.cast("decimal(30,6)"), prior_count, 3)).alias("drop_pct"),
        _verdict((prior_count > 0) & (dropped > prior_count * max_drop_pct)).alias("check_result"),
    )


def null_rates(table: str, df: DataFrame, columns: Sequence[str], max_null_pct: float = MAX_NULL_PCT) -> DataFrame:
    """Null rate of several columns in one scan; an empty table is reported as such."""
    wide = df.agg(
        F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    cells = [cell for i, c in enumerate(columns) for cell in (F.lit(c), F.col(f"c{i}"))]
    long = wide.select("total", F.stack(F.lit(len(columns)), *cells).alias("column_name", "null_rows"))
    hundredfold = F.col("null_rows") * 100
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "null_rows",
        F.col("total").alias("row_count"),
        ratio(hundredfold.cast("decimal(30,6)"), F.col("total"), 3).alias("null_rate_pct"),
        F.when(F.col("total") == 0, "empty")
        .when(hundredfold > F.col("total") * max_null_pct, "fail")
        .otherwise("pass")
        .alias("check_result"),
    )


def freshness(
    table: str, df: DataFrame, column: str, as_of: str | dt.date, max_days: int = MAX_STALE_DAYS
) -> DataFrame:
    """Days between the latest date and ``as_of``; no date at all fails."""
    newest = df.agg(F.max(F.col(column).cast("date")).alias("max_date"))
    stale = F.date_diff(as_date(as_of), F.col("max_date"))
    return newest.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        "max_date",
        stale.alias("days_stale"),
        _verdict(F.col("max_date").isNull() | (stale > max_days)).alias("check_result"),
    )


def schema_contract(table: str, df: DataFrame, expected: T.StructType) -> DataFrame:
    """Declared against actual column types, with the number of filled rows per actual column."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    declared = {field.name: field.dataType.simpleString() for field in expected.fields}

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in declared:
            return "unexpected"
        return "ok" if actual[name] == declared[name] else "type_mismatch"

    names = list(dict.fromkeys([*declared, *actual]))
    filled = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(names) if name in actual])
    no_text, no_count = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    cells: list[Column] = []
    for i, name in enumerate(names):
        cells += [
            F.lit(name),
            F.lit(declared[name]) if name in declared else no_text,
            F.lit(actual[name]) if name in actual else no_text,
            F.lit(status(name)),
            F.col(f"c{i}") if name in actual else no_count,
        ]
    labels = ["column_name", "expected_type", "actual_type", "status", "filled_rows"]
    return filled.select(F.lit(table).alias("table_name"), F.stack(F.lit(len(names)), *cells).alias(*labels))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("none")) for p in parts])


def audit_rows(
    run_timestamp: dt.datetime, run_id: str, drops: DataFrame, nulls: Sequence[DataFrame], fresh: DataFrame
) -> DataFrame:
    """All results of a run in the audit-log layout. The logged result is the real one."""
    no_text, no_count, no_rate = (F.lit(None).cast(t) for t in ("string", "bigint", "double"))

    def layout(df: DataFrame, kind: str, column: Column, count: Column, rate: Column, details: Column) -> DataFrame:
        return df.select(
            F.lit(run_timestamp).cast("timestamp").alias("run_timestamp"),
            F.lit(run_id).alias("run_id"),
            F.lit(kind).alias("check_type"),
            "table_name",
            column.alias("column_name"),
            "check_result",
            count.alias("row_count"),
            rate.alias("null_rate_pct"),
            details.alias("details"),
        )

    rate = F.col("null_rate_pct").cast("double")
    frames = [
        layout(drops, "row_count", no_text, F.col("row_count"), no_rate, _text("row_count=", F.col("row_count"))),
        *[
            layout(n, "null_rate", F.col("column_name"), no_count, rate, _text("null_rate=", F.col("null_rate_pct"), "%"))
            for n in nulls
        ],
        layout(
            fresh,
            "freshness",
            F.col("column_name"),
            no_count,
            no_rate,
            _text("max_date=", F.col("max_date"), ", days_stale=", F.col("days_stale")),
        ),
    ]
    return union_all(frames).select(*AUDIT_LOG.fieldNames())


def overall_result(audit: DataFrame) -> DataFrame:
    """One row: pass only if every check of the run passed."""
    return audit.agg(_verdict(F.count_if(F.col("check_result") == "fail") > 0).alias("check_result"))


def unexpired(audit_log: DataFrame, as_of: str | dt.date, keep_days: int = 365) -> DataFrame:
    """Audit rows inside the retention period; on a log partitioned by ``run_date`` this prunes partitions."""
    return audit_log.where(F.col("run_date") >= F.date_sub(as_date(as_of), keep_days))
