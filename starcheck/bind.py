"""Patient-record tables derived by Spark from the driver's star-schema tables.

Scaffolding only: the library takes raw tables as arguments and never imports this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.plans.datasets import Datasets
from cohortry.session import configure
from cohortry.sources.readers import RawTables
from cohortry.vocabulary import CONDITION_FLAGS

YEAR = 2001
AS_OF = "2001-12-31"


# Declared, so that no job is spent on reading file footers for a schema.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def condition_map_rows() -> list[tuple[str, str, str, str]]:
    """(code, category, group, weight): one code per category and a second code for two of them."""
    rows = [
        (str(i * 3), category, f"HCC{i}", f"{0.05 + (i % 7) * 0.06:.3f}") for i, category in enumerate(CONDITION_FLAGS)
    ]
    return [*rows, ("60", "diabetes_t2", "HCC0", "0.110"), ("63", "chf", "HCC1", "0.170")]


def condition_map(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"('{code}', '{cat}', '{cat}', '{group}', {weight}D)" for code, cat, group, weight in condition_map_rows())
    columns = "snomed_code, condition_category, condition_label, hcc_category, hcc_weight"
    return spark.sql(f"select * from values {values} as seed({columns})")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = star(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = star(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return customers.selectExpr(
        "cast(c_custkey as string) as Id",
        "date_add(date'1935-01-01', cast(c_custkey * 7919 % 22000 as int)) as BIRTHDATE",
        "case when c_custkey % 17 = 0 then date_add(date'1999-06-30', cast(c_custkey % 700 as int)) end as DEATHDATE",
        "case when c_custkey % 50 = 0 then null when c_custkey % 2 = 0 then 'f' else 'M' end as GENDER",
        "c_mktsegment as RACE",
        "case when c_custkey % 4 = 0 then 'hispanic' else 'nonhispanic' end as ETHNICITY",
        "n_name as STATE",
        "concat('city ', c_nationkey) as CITY",
        "lpad(cast(c_custkey % 100000 as string), 5, '0') as ZIP",
        "cast((cast(c_acctbal as decimal(18,2)) + 1000) * 60 as decimal(18,2)) as HEALTHCARE_EXPENSES",
        "case when c_custkey % 13 <> 0 then cast((cast(c_acctbal as decimal(18,2)) + 1000) * 40 as decimal(18,2)) end"
        " as HEALTHCARE_COVERAGE",
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row, so the broadcast has a fixed size.
    supplier_count = star(spark, sf_dir, "supplier").agg(F.count("*").alias("suppliers"))
    orders = star(spark, sf_dir, "orders").crossJoin(F.broadcast(supplier_count))
    start = "cast(o_orderdate as timestamp)"
    cost = "cast(o_totalprice as decimal(18,2))"
    return orders.selectExpr(
        "cast(o_orderkey as string) as Id",
        "cast(o_custkey as string) as PATIENT",
        "case when o_orderkey % 97 = 0 then null when o_orderkey % 101 = 0 then ''"
        " else cast((o_custkey * 13 + o_orderkey % 3) % suppliers as string) end as PROVIDER",
        "cast(o_orderkey % 5 as string) as PAYER",
        f"{start} as START",
        f"{start} + make_dt_interval(cast(o_orderkey % 6 as int)) as STOP",
        "case o_orderpriority when '1-URGENT' then 'emergency' when '2-HIGH' then 'Inpatient'"
        " when '3-MEDIUM' then case o_orderkey % 4 when 0 then 'urgentcare' when 1 then 'outpatient'"
        " when 2 then 'ambulatory' else 'hospice' end"
        " when '4-NOT SPECIFIED' then 'wellness'"
        " else case when o_orderkey % 2 = 0 then 'office' else 'home' end end as ENCOUNTERCLASS",
        "case when o_orderkey % 3 <> 0 then cast(o_orderkey % 200 as string) end as REASONCODE",
        "case when o_orderkey % 3 <> 0 then concat('reason ', o_orderkey % 200) end as REASONDESCRIPTION",
        "o_orderstatus as CODE",
        "o_orderpriority as DESCRIPTION",
        f"cast(round({cost} * 0.5BD, 2) as decimal(18,2)) as BASE_ENCOUNTER_COST",
        f"{cost} as TOTAL_CLAIM_COST",
        f"case when o_orderkey % 19 <> 0 then cast(round({cost} * 0.8BD, 2) as decimal(18,2)) end as PAYER_COVERAGE",
    )


def _lines(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    lines = star(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)
    orders = star(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


SHIPPED = "cast(l_shipdate as date)"
CLOSED = f"case when l_linestatus <> 'O' then date_add({SHIPPED}, 90) end"


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "R").selectExpr(
        "cast(o_custkey as string) as PATIENT",
        "cast(case when l_partkey % 53 = 0 then -1 else l_orderkey end as string) as ENCOUNTER",
        f"{SHIPPED} as START",
        f"{CLOSED} as STOP",
        "cast(l_partkey % 200 as string) as CODE",
        "concat('condition ', l_partkey % 200) as DESCRIPTION",
    )


def procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "N").selectExpr(
        "cast(o_custkey as string) as PATIENT",
        "cast(l_orderkey as string) as ENCOUNTER",
        f"{SHIPPED} as DATE",
        "case l_partkey % 40 when 0 then '43396009' when 1 then '252779009' when 2 then '6615001'"
        " when 3 then '182836005' when 4 then '428191000124101' when 5 then '59408-5' when 6 then '410453006'"
        " else cast(l_partkey % 40 as string) end as CODE",
        "concat('procedure ', l_partkey % 40) as DESCRIPTION",
        "cast(l_extendedprice as decimal(18,2)) as BASE_COST",
    )


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "cast(l_extendedprice as decimal(18,2))"
    return _lines(spark, sf_dir, "A").selectExpr(
        "cast(o_custkey as string) as PATIENT",
        "cast(l_orderkey as string) as ENCOUNTER",
        "cast(l_suppkey % 5 as string) as PAYER",
        f"{SHIPPED} as START",
        f"{CLOSED} as STOP",
        "cast(l_partkey % 300 as string) as CODE",
        "concat('drug ', l_partkey % 300) as DESCRIPTION",
        f"cast(round({price} * 0.5BD, 2) as decimal(18,2)) as BASE_COST",
        f"case when l_linenumber <> 3 then cast(round({price} * 0.7BD, 2) as decimal(18,2)) end as PAYER_COVERAGE",
        f"{price} as TOTALCOST",
        "case when l_linenumber <> 7 then cast(l_quantity as bigint) end as DISPENSES",
        "case when l_partkey % 7 <> 0 then cast(l_partkey % 200 as string) end as REASONCODE",
        "case when l_partkey % 7 <> 0 then concat('reason ', l_partkey % 200) end as REASONDESCRIPTION",
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as string) as Id")


DERIVED = {
    "patients": patients,
    "encounters": encounters,
    "conditions": conditions,
    "procedures": procedures,
    "medications": medications,
    "providers": providers,
    "condition_map": lambda spark, sf_dir: condition_map(spark),
}


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    configure(spark)
    return RawTables(lambda table: DERIVED[table](spark, sf_dir))


def datasets(spark: SparkSession, sf_dir: str) -> Datasets:
    return Datasets(raw_tables(spark, sf_dir), YEAR, AS_OF)
