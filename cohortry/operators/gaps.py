"""Care-gap measures and 30-day readmissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.codes import code_in
from cohortry.functions.keys import surrogate_key
from cohortry.vocabulary import GAP_MEASURES, MIN_DRUGS, READMISSION_DAYS, SERVICE_CODES


def polypharmacy_members(drugs: DataFrame, min_drugs: int = MIN_DRUGS) -> DataFrame:
    """Members on at least ``min_drugs`` distinct drugs."""
    return drugs.where(F.col("distinct_drugs") >= min_drugs)


def member_services(procedures: DataFrame, year: int | None = None) -> DataFrame:
    """Per member, which gap-closing services were done and when last.

    The union of all code lists is filtered at the scan, so only relevant procedures are shuffled,
    already reduced to one partial row per member and task. With ``year`` only services of that
    year count.
    """
    listed = sorted({code for closing, dated in SERVICE_CODES.values() for code in closing + dated})
    relevant = procedures.where(code_in("snomed_code", listed))
    if year is not None:
        relevant = relevant.where(F.col("procedure_year") == year)
    measures: list[Column] = []
    for service, (closing, dated) in SERVICE_CODES.items():
        done = code_in("snomed_code", closing)
        on = F.when(code_in("snomed_code", dated), F.col("procedure_date"))
        measures += [F.max(done.cast("int")).alias(f"had_{service}"), F.max(on).alias(f"last_{service}_date")]
    return relevant.groupBy("member_id").agg(*measures)


def _cohorts(profile: DataFrame, min_drugs: int) -> DataFrame:
    return profile.select(
        "member_id",
        "measurement_year",
        (F.col("cc_diabetes") == 1).alias("is_diabetic"),
        (F.col("distinct_drugs") >= min_drugs).alias("is_polypharmacy"),
    )


def care_gap_services(
    profile: DataFrame, procedures: DataFrame, min_drugs: int = MIN_DRUGS, year: int | None = None
) -> DataFrame:
    """Service flags and dates of every member in a diabetes or polypharmacy denominator."""
    eligible = _cohorts(profile, min_drugs).where("is_diabetic or is_polypharmacy")
    joined = eligible.join(member_services(procedures, year), "member_id", "left")
    return joined.select(
        "member_id",
        "is_diabetic",
        "is_polypharmacy",
        *[F.coalesce(f"had_{service}", F.lit(0)).alias(f"had_{service}") for service in SERVICE_CODES],
        *[f"last_{service}_date" for service in SERVICE_CODES],
    )


def readmission_flags(
    encounters: DataFrame, min_days: int = READMISSION_DAYS[0], max_days: int = READMISSION_DAYS[1]
) -> DataFrame:
    """Members with an inpatient stay, and whether one began ``min_days..max_days`` after the stay before it.

    Stays are ordered by admission date, then encounter id. A per-member window over all stays would
    put one member's stays into one task, so each admission day is aggregated first: every stay of a
    day but the last is followed by a stay admitted on that same day, so only its own discharge
    decides, and only the last one's discharge matters to later days. The window then sees one row
    per calendar day of a member.
    """
    admitted, discharged = F.col("service_date"), F.col("service_end_date")

    def comes_back(days_home: Column) -> Column:
        return F.coalesce(days_home.between(min_days, max_days), F.lit(False))

    days = (
        encounters.where(F.col("claim_type") == "inpatient")
        .groupBy("member_id", admitted.alias("admitted"))
        .agg(
            F.count_if(comes_back(F.date_diff(admitted, discharged))).alias("early_discharges"),
            F.max_by(discharged, "encounter_id").alias("last_discharge"),
        )
    )
    last_is_early = comes_back(F.date_diff("admitted", "last_discharge")).cast("int")
    before = F.lag("last_discharge").over(Window.partitionBy("member_id").orderBy("admitted"))
    return (
        days.withColumn("days_home", F.date_diff("admitted", before))
        .withColumn("readmitted", (F.col("early_discharges") > last_is_early) | comes_back(F.col("days_home")))
        .groupBy("member_id")
        .agg(
            F.max(F.col("readmitted").cast("int")).alias("had_readmission"),
            F.max(F.when(F.col("readmitted"), F.col("admitted"))).alias("readmission_date"),
        )
    )


def mart_care_gaps(
    profile: DataFrame,
    procedures: DataFrame,
    encounters: DataFrame,
    min_drugs: int = MIN_DRUGS,
    year: int | None = None,
    inpatient_only: bool = False,
) -> DataFrame:
    """One row per member and measure the member is eligible for; ``gap_open`` is 1 when care is due.

    Every member has a readmission row, where ``gap_open`` = 1 means a readmission happened;
    ``inpatient_only`` limits that measure to members with an inpatient stay. All measures come from
    one pass over the members instead of one branch per measure.
    """
    base = (
        _cohorts(profile, min_drugs)
        .join(member_services(procedures, year), "member_id", "left")
        .join(readmission_flags(encounters), "member_id", "left")
    )
    everyone = F.col("had_readmission").isNotNull() if inpatient_only else F.lit(True)

    def still_due(service: str) -> Column:
        return 1 - F.coalesce(f"had_{service}", F.lit(0))

    # Measure -> (eligible, open, date).
    outcome = {
        "diabetes_a1c": (F.col("is_diabetic"), still_due("a1c"), F.col("last_a1c_date")),
        "diabetes_eye_exam": (F.col("is_diabetic"), still_due("eye_exam"), F.col("last_eye_exam_date")),
        "high_risk_med_review": (F.col("is_polypharmacy"), still_due("med_review"), F.col("last_med_review_date")),
        "readmission_30d": (everyone, F.coalesce("had_readmission", F.lit(0)), F.col("readmission_date")),
    }
    cells: list[Column] = []
    for gap_type, (label, definition) in GAP_MEASURES.items():
        cells += [F.lit(gap_type), F.lit(label), F.lit(definition), *outcome[gap_type]]
    names = ["gap_type", "gap_label", "gap_definition", "eligible", "gap_open", "last_service_date"]
    rows = base.select("member_id", "measurement_year", F.stack(F.lit(len(GAP_MEASURES)), *cells).alias(*names))
    return rows.where("eligible").select(
        surrogate_key("member_id", "gap_type", "measurement_year").alias("gap_id"),
        "member_id",
        "measurement_year",
        "gap_type",
        "gap_label",
        "gap_open",
        "last_service_date",
        "gap_definition",
    )
