"""Sizes measured while tables are written, and the shuffle partitions planned from them.

Adaptive execution merges small shuffle partitions but never cuts one below the planned number, so the number must come
from the data. Row counts and the average width of every column are collected on the way of each staging write; a
stage's largest shuffle is then known from the columns it moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.session import configure

ROW_BYTES, VALUE_BYTES = 16, 8
"""What a shuffled row and each of its values take besides the bytes of texts."""

# What the largest shuffle of each stage moves: (table, columns) of the sides that are dealt out by one key.
STAGES: dict[str, list[tuple[str, tuple[str, ...]]]] = {
    "spine": [
        ("stg_conditions", ("condition_id", "member_id", "encounter_id", "snomed_code", "condition_description")),
        ("stg_procedures", ("procedure_id", "member_id", "encounter_id", "snomed_code")),
        ("stg_encounters", ("encounter_id", "service_date", "service_end_date", "provider_id", "claim_type", "service_year", "encounter_class")),
    ],
    "chronic_flags": [("stg_conditions", ("member_id", "snomed_code", "onset_date"))],
    "risk_profile": [
        ("stg_members", ("member_id", "sex", "race", "ethnicity", "state", "city", "zip_code", "total_healthcare_expenses")),
        ("stg_encounters", ("encounter_id", "member_id", "paid_amount")),
        ("stg_medications", ("member_id", "rxnorm_code", "total_drug_cost")),
    ],
    "care_gaps": [("stg_encounters", ("member_id", "service_date", "encounter_id")), ("stg_members", ("member_id",))],
    "providers": [("stg_encounters", ("encounter_id", "member_id", "provider_id", "claim_type", "paid_amount"))],
}


@dataclass
class TableSize:
    """Rows of a table and the average bytes of each column's values."""

    rows: int
    widths: dict[str, float] = field(default_factory=dict)

    def bytes(self, columns: Iterable[str] | None = None) -> int:
        """About what a shuffle of these columns, by default of all, moves."""
        chosen = list(self.widths if columns is None else columns)
        return round(self.rows * (ROW_BYTES + sum(VALUE_BYTES + self.widths.get(c, 0.0) for c in chosen)))


class Measure:
    """Collects a table's size while it is written."""

    def __init__(self) -> None:
        self._seen = Observation()
        self._columns: list[str] = []
        self._texts: list[str] = []

    def on(self, df: DataFrame) -> DataFrame:
        self._columns = df.columns
        self._texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        widths = [F.sum(F.octet_length(F.col(f"`{c}`"))).alias(f"w{i}") for i, c in enumerate(self._texts)]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *widths)

    def size(self) -> TableSize:
        found = self._seen.get
        rows = found["rows"]
        texts = {c: (found[f"w{i}"] or 0) / rows if rows else 0.0 for i, c in enumerate(self._texts)}
        return TableSize(rows, {c: texts.get(c, 0.0) for c in self._columns})


def stage_bytes(stage: str, sizes: Mapping[str, TableSize]) -> int:
    return sum(sizes[table].bytes(columns) for table, columns in STAGES[stage])


def plan_stage(spark: SparkSession, stage: str, sizes: Mapping[str, TableSize]) -> None:
    """Set the shuffle partitions that a stage starts with."""
    configure(spark, stage_bytes(stage, sizes))
