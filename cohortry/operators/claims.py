"""The claim-line spine: encounters plus their diagnosis and procedure lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.keys import packed_key, unpacked_key
from cohortry.schemas import MONEY

LINE_COLUMNS = [
    "claims_line_id",
    "claim_id",
    "member_id",
    "service_date",
    "service_end_date",
    "provider_npi",
    "claim_type",
    "dx_code",
    "dx_description",
    "procedure_code",
    "paid_amount",
    "service_year",
    "encounter_class",
]


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _no_spend() -> Column:
    return F.lit(0).cast(MONEY)


def _line(key: str, dx_code: Column, dx_description: Column, procedure_code: Column, paid: Column) -> list[Column]:
    return [
        F.col(key).alias("claims_line_id"),
        F.col("encounter_id").alias("claim_id"),
        F.col("member_id"),
        dx_code.alias("dx_code"),
        dx_description.alias("dx_description"),
        procedure_code.alias("procedure_code"),
        paid.alias("paid_amount"),
    ]


def _encounter_context(encounters: DataFrame) -> DataFrame:
    return encounters.select(
        F.col("encounter_id").alias("claim_id"),
        "service_date",
        "service_end_date",
        F.col("provider_id").alias("provider_npi"),
        "claim_type",
        "service_year",
        "encounter_class",
    )


def _dx_detail(conditions: DataFrame) -> DataFrame:
    return conditions.select(
        *_line("condition_id", F.col("snomed_code"), F.col("condition_description"), _no_text(), _no_spend())
    )


def _procedure_detail(procedures: DataFrame) -> DataFrame:
    return procedures.select(*_line("procedure_id", _no_text(), _no_text(), F.col("snomed_code"), _no_spend()))


def heavy_claims(detail: DataFrame, partitions: int) -> DataFrame:
    """(claim_id, pieces) of the claims with more than a quarter of a partition's share of all lines.

    A frequency sketch of bounded size finds them in the scan that counts the lines, without a shuffle by claim. There are at
    most ``4 * partitions`` of them, so the table has a size bound. The sketch's counts only choose the number of pieces.
    """
    ways = 4 * partitions
    counted = detail.where(F.col("claim_id").isNotNull()).agg(
        F.expr(f"approx_top_k(claim_id, {ways}, {min(64 * ways, 1_000_000)})").alias("top"), F.count("*").alias("lines")
    )
    heavy = counted.select("lines", F.inline("top")).where(F.col("count") * ways > F.col("lines"))
    # Pieces are four times as fine, so that those which meet in one partition by chance make no large one.
    pieces = F.ceil(F.col("count") * (4 * ways) / F.col("lines")).cast("int")
    return heavy.select(F.col("item").alias("claim_id"), pieces.alias("pieces"))


def _within_encounters(detail: DataFrame, encounters: DataFrame) -> DataFrame:
    """Lines with their encounter's columns; lines without a known encounter are dropped.

    The lines of a heavy claim are dealt into pieces by their own key, and only its encounter row is repeated once per piece; all
    other claims are one piece. Line keys are shuffled packed.
    """
    context = _encounter_context(encounters)
    partitions = int(detail.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most four rows per shuffle partition.
    heavy = F.broadcast(heavy_claims(detail.select("claim_id"), partitions))
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = detail.join(heavy, "claim_id", "left").withColumn("_piece", F.pmod(F.xxhash64("claims_line_id", "member_id"), pieces).cast("int")).drop("pieces")
    dealt = dealt.withColumn("claims_line_id", packed_key(F.col("claims_line_id")))
    spread = context.join(heavy, "claim_id", "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces")
    joined = dealt.join(spread, ["claim_id", "_piece"])
    return joined.withColumn("claims_line_id", unpacked_key(F.col("claims_line_id"))).select(*LINE_COLUMNS)


def claims_dx_lines(conditions: DataFrame, encounters: DataFrame) -> DataFrame:
    """Diagnosis lines, at zero spend."""
    return _within_encounters(_dx_detail(conditions), encounters)


def claims_procedure_lines(procedures: DataFrame, encounters: DataFrame) -> DataFrame:
    """Procedure lines, at zero spend."""
    return _within_encounters(_procedure_detail(procedures), encounters)


def int_claims_unioned(encounters: DataFrame, conditions: DataFrame, procedures: DataFrame) -> DataFrame:
    """One row per encounter, diagnosis line and procedure line; spend sits on the encounter row only.

    Diagnosis and procedure lines are put together first, so encounters are shuffled once for both.
    """
    headers = encounters.select(
        *_line("encounter_id", F.col("reason_snomed_code"), F.col("reason_description"), _no_text(), F.col("paid_amount")),
        "service_date",
        "service_end_date",
        F.col("provider_id").alias("provider_npi"),
        "claim_type",
        "service_year",
        "encounter_class",
    ).select(*LINE_COLUMNS)
    detail = _dx_detail(conditions).unionByName(_procedure_detail(procedures))
    return headers.unionByName(_within_encounters(detail, encounters))


def panel_of_spine(spine: DataFrame) -> DataFrame:
    """``claim_panel`` from a written spine: its lines counted per claim and member, before any shuffle within each task."""
    keys = ["claim_id", "member_id", "provider_npi", "claim_type"]
    return spine.groupBy(*keys).agg(F.count("*").alias("lines"), F.sum("paid_amount").cast(MONEY).alias("paid_amount"))


def claim_panel(encounters: DataFrame, conditions: DataFrame, procedures: DataFrame) -> DataFrame:
    """The spine counted per claim and member: number of lines and spend.

    Equal to grouping ``int_claims_unioned``, but diagnosis and procedure lines are counted before
    they meet their encounters, so a claim with very many lines enters the join as one row per member.
    """
    detail = (
        conditions.select("encounter_id", "member_id")
        .unionByName(procedures.select("encounter_id", "member_id"))
        .where(F.col("encounter_id").isNotNull())
        .groupBy(F.col("encounter_id").alias("claim_id"), "member_id")
        .agg(F.count("*").alias("lines"))
    )
    context = _encounter_context(encounters).select("claim_id", "provider_npi", "claim_type")
    headers = encounters.select(
        F.col("encounter_id").alias("claim_id"),
        "member_id",
        F.lit(1).cast("bigint").alias("lines"),
        F.col("provider_id").alias("provider_npi"),
        "claim_type",
        "paid_amount",
    )
    return headers.unionByName(detail.join(context, "claim_id").withColumn("paid_amount", _no_spend()))
