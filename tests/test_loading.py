"""CSV records in one pass, and published versions of tables."""

from __future__ import annotations

import csv
import io
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.sources import csv_records, published, readers, writers

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
TEXT = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


@pytest.fixture
def block_size(spark):
    """``block_size("64")``: files are split into blocks of so many bytes."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {k: spark.conf.get(k, None) for k in keys}

    def put(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "1")

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_surplus_fields_are_rejected_not_lost(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,x\n3,4,5\n6,"y,z"\n7,\n8\n9,"q",\n')
    for quoted in (True, False):
        with pytest.raises(writers.LoadError, match="2 rows"):
            writers.load_csv(spark, str(tmp_path / "t.csv"), AB, str(tmp_path / "raw"), "t", quoted)
        bad = {r["_record"]: (r["a"], r["b"], r["_misfits"]) for r in readers.read_rejected(spark, str(tmp_path / "raw"), "t").collect()}
        assert bad == {"3,4,5": ("3", "4", csv_records.SURPLUS), '9,"q",': ("9", "q", csv_records.SURPLUS)}
        assert writers.load_csv(spark, str(tmp_path / "t.csv"), AB, str(tmp_path / "raw"), "t", quoted, max_rejected=2) == 4
        kept = readers.read_table(spark, str(tmp_path / "raw"), "t")
        assert kept.schema == AB and Counter(map(tuple, kept.collect())) == Counter([(1, "x"), (6, "y,z"), (7, None), (8, None)])
        with pytest.raises(Exception, match="more fields than the header"):
            readers.read_csv(spark, str(tmp_path / "t.csv"), AB, quoted).collect()


def _field(rng):
    kind = rng.randrange(8)
    if kind < 3:
        return "".join(rng.choice("xyz 5") for _ in range(rng.randrange(6)))
    if kind == 3:
        return 'q"uote inside'
    return '"' + "".join(rng.choice(['""', "\n", "\r\n", ",", "w", "é", " ", '"",""', "\n\n"]) for _ in range(rng.randrange(12))) + '"'


@pytest.mark.parametrize(("seed", "size"), [(1, "61"), (2, "7"), (3, "200"), (4, "128m")])
def test_records_equal_a_sequential_reader_however_files_are_split(spark, tmp_path, block_size, seed, size):
    rng = random.Random(seed)
    expected = Counter()
    for name in ("one", "two"):
        lines = ["a,b,c"]
        for _ in range(60):
            lines.append(",".join(_field(rng) for _ in range(3)))
        text = "\n".join(lines) + "\n"
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        for row in list(csv.reader(io.StringIO(text, newline=""), strict=False))[1:]:
            if "".join(row):  # empty and missing fields are not told apart here
                expected[tuple(x or None for x in row)] += 1
    block_size(size)
    found = csv_records.read_records(spark, str(tmp_path), TEXT)
    rows = Counter(tuple(r[c] or None for c in "abc") for r in found.collect() if any(r[c] for c in "abc"))
    assert rows == expected
    assert found.where("_surplus").count() == 0


def test_a_record_over_many_blocks(spark, tmp_path, block_size):
    long = "\n".join(f"line {k}, with commas" for k in range(400))
    text = f'a,b,c\n1,"{long}",x\n2,y,z\n'
    (tmp_path / "t.csv").write_text(text)
    block_size("50")
    found = csv_records.read_records(spark, str(tmp_path / "t.csv"), TEXT).orderBy("a").collect()
    assert [(r["a"], r["b"], r["c"]) for r in found] == [("1", long, "x"), ("2", "y", "z")]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_records_over_the_edges_of_chunks(spark, tmp_path, block_size, monkeypatch, bits):
    monkeypatch.setattr(csv_records, "CHUNK_BITS", bits)
    rows = [("a", "b", "c"), *[(str(n), "\n".join(f'line {k}, "{n}"' for k in range(n % 7)), "é" * (n % 5)) for n in range(120)]]
    with open(tmp_path / "t.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows(rows)
    block_size("700")
    found = csv_records.read_records(spark, str(tmp_path / "t.csv"), TEXT)
    assert sorted(tuple(r[c] or "" for c in "abc") for r in found.collect()) == sorted(rows[1:])


def test_the_text_of_longer_records_is_shuffled_once(spark, tmp_path, block_size):
    """Records within a chunk are put together where their lines lie, and no window holds a whole block."""
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f'{n},"two\nlines {n}"\n' for n in range(20_000)))
    block_size("50m")
    found = csv_records._records(csv_records._lines(spark, str(tmp_path / "t.csv"), None), [])
    placed = csv_records._placed(csv_records._lines(spark, str(tmp_path / "t.csv"), None))
    broken = placed.where("(_starts_inside or _ends_inside) and _broken")
    assert found.count() == 20_001 and 0 < broken.count() < 40
    assert placed.groupBy("_file", "_block", "_chunk").count().where("count > 4096").isEmpty()


def test_large_quoted_files_make_many_tasks_and_one_scan(spark, tmp_path, block_size):
    rows = "".join(f'{n},"two\nlines {n}"\n' for n in range(20_000))
    (tmp_path / "t.csv").write_text("a,b\n" + rows)
    block_size("50k")
    found = csv_records.read_records(spark, str(tmp_path / "t.csv"), AB)
    assert csv_records._lines(spark, str(tmp_path / "t.csv"), None).rdd.getNumPartitions() > 5
    assert found.where("b = concat('two\nlines ', a)").count() == 20_000
    # The line scan is one exchange that all branches share.
    plan = found.select("a", "b")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan text") == 1 and "ReusedExchange" in text


def test_a_load_reads_its_files_once(spark, tmp_path, monkeypatch):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\nnone,z\n')
    calls = []
    whole = csv_records._lines
    monkeypatch.setattr(csv_records, "_lines", lambda *args: calls.append(args) or whole(*args))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "load")
    assert writers.load_csv(spark, str(tmp_path / "t.csv"), AB, str(tmp_path / "raw"), "t", max_rejected=1) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(calls) == 1 and jobs.getJobIdsForGroup("load")
    assert [r["_misfits"] for r in readers.read_rejected(spark, str(tmp_path / "raw"), "t").collect()] == ["a"]


def test_files_with_another_header_are_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "in/2.csv").write_text("b,a\nx,1\n")
    for quoted in (True, False):
        with pytest.raises(Exception, match="header"):
            readers.read_csv(spark, str(tmp_path / "in"), AB, quoted).collect()


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n\n  \n")
    assert writers.load_csv(spark, str(tmp_path / "t.csv"), AB, str(tmp_path / "raw"), "t") == 0
    assert readers.read_table(spark, str(tmp_path / "raw"), "t").schema == AB
    assert readers.read_table(spark, str(tmp_path / "raw"), "t").count() == 0
    assert readers.read_rejected(spark, str(tmp_path / "raw"), "t").count() == 0
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(readers.SchemaError):
        readers.read_csv(spark, str(tmp_path / "e.csv"), AB)


# Published versions


def yearly(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, measurement_year int")


def keys(df):
    return sorted(r["k"] for r in df.collect())


def test_an_empty_year_empties_the_year(spark, tmp_path):
    base = str(tmp_path)
    writers.write_mart(yearly(spark, ("a", 2000)), base, "m", 2000)
    writers.write_mart(yearly(spark, ("b", 2001)), base, "m", 2001)
    back = writers.write_mart(yearly(spark).where("false"), base, "m", 2001)
    assert back.count() == 0 and keys(readers.read_mart(spark, base, "m")) == ["a"]
    assert readers.read_mart(spark, base, "m", 2001).count() == 0
    marts = readers.StoredMarts(spark, base)
    assert marts.names() == ["m"] and marts.years("m") == [2000, 2001]
    # Every year empty: the schema is still there.
    writers.write_mart(yearly(spark).where("false"), base, "m", 2000)
    assert readers.read_mart(spark, base, "m").columns == ["k", "_loaded_at", "measurement_year"] or "k" in readers.read_mart(spark, base, "m").columns
    assert readers.read_mart(spark, base, "m").count() == 0


def test_rows_of_an_unstated_year_fail_and_change_nothing(spark, tmp_path):
    base = str(tmp_path)
    writers.write_mart(yearly(spark, ("a", 2000)), base, "m", 2000)
    for odd in (("c", 2000), ("c", None)):
        with pytest.raises(published.PublishError, match="1 rows lie outside"):
            writers.write_mart(yearly(spark, ("b", 2001), odd), base, "m", 2001)
    assert keys(readers.read_mart(spark, base, "m")) == ["a"]


@pytest.mark.parametrize("partition_by", [None, "measurement_year"])
def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    published.publish(yearly(spark, ("a", 2000), ("b", 2001)), path, partition_by)
    opened = published.open_version(spark, path)
    broken = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("c").cast("string").alias("k"), F.lit(2001).alias("measurement_year")
    )
    with pytest.raises(Exception, match="lost"):
        published.publish(broken, path, partition_by, [2001] if partition_by else None)
    assert keys(published.open_version(spark, path)) == keys(opened) == ["a", "b"]
    # Its leftovers go when versions are cleaned up, and the next write succeeds.
    published.publish(yearly(spark, ("d", 2001)), path, partition_by, [2001] if partition_by else None)
    assert keys(published.open_version(spark, path)) == (["a", "d"] if partition_by else ["d"])
    assert keys(published.open_version(spark, path, version=1)) == ["a", "b"]
    published.expire_versions(spark, path)
    assert keys(published.open_version(spark, path)) == (["a", "d"] if partition_by else ["d"])
    assert len(published.Store(spark, path).folders()) == (2 if partition_by else 1)
    with pytest.raises(published.PublishError, match="no version 1"):
        published.open_version(spark, path, version=1)


def test_of_two_writers_of_one_version_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    first = published.publish(yearly(spark, ("a", 2000)), path)
    store = published.Store(spark, path)
    with pytest.raises(published.PublishError, match="another writer"):
        store.commit(first)
    assert [n for n in store.names(published.MANIFESTS) if not n.endswith(".crc")] == ["00000001.json"]
    assert json.loads((tmp_path / "t/_versions/00000001.json").read_text())["rows"] == {"": 1}
    with pytest.raises(published.PublishError, match="partitioned by"):
        published.publish(yearly(spark, ("a", 2000)), path, "measurement_year")


def test_one_year_is_one_folder_in_the_scan(spark, tmp_path):
    base = str(tmp_path)
    for year in (2000, 2001):
        writers.write_mart(yearly(spark, (f"m{year}", year)), base, "m", year)
    one = readers.StoredMarts(spark, base).mart("m", 2001)
    assert keys(one) == ["m2001"]
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_year" in scan
    assert len(one.inputFiles()) and {f.split("measurement_year=")[1][:4] for f in one.select("k").inputFiles()} >= {"2001"}
    # A reader that has opened a version keeps it while a new one is published.
    writers.write_mart(yearly(spark, ("new", 2001)), base, "m", 2001)
    assert keys(one) == ["m2001"] and keys(readers.read_mart(spark, base, "m", 2001)) == ["new"]
