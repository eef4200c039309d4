"""Regions of sheets over several stretches of a file, and stored tables that change in one step or not at all."""

from __future__ import annotations

import os

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from panelspark.sinks.manifest import Constraints, ConstraintError, Warehouse
from panelspark.sources.regions import Region, column_letters, column_number, numbered_lines, read_region

# Regions


def test_addresses():
    assert Region.parse("'Tableau 1'!A3:B37") == Region(3, 1, 37, 2)
    assert Region.parse("'Data'!A5") == Region(5, 1)
    assert Region.parse("B2:AA") == Region(2, 2, None, 27)
    assert [column_letters(column_number(c)) for c in ("A", "Z", "AA", "AZ", "BA", "ZZ", "AAA")] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]
    for bad in ("3A", "A0", "A5:A3", "C1:B2", "A1:B2:C3", ""):
        with pytest.raises(ValueError):
            Region.parse(bad)


@pytest.fixture
def small_stretches(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "700")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def sheets(tmp_path):
    """Two files of about ten stretches each, and a short one."""
    content = {}
    for name, n in (("one", 400), ("two", 250), ("three", 4)):
        lines = ["title é;;", "", "key;label;value"] + [f"{k};row {k};{'' if k % 7 == 0 else k * 2}" for k in range(4, n + 1)] + ["total;;"]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
        content[name] = lines
    return tmp_path, content


@pytest.mark.parametrize(("first", "last"), [(1, None), (3, 37), (120, 260), (399, 402), (500, 600)])
def test_lines_are_numbered_over_stretches(spark, small_stretches, sheets, first, last):
    folder, content = sheets
    lines = numbered_lines(spark, [f"{folder}/*.csv"], first, last)
    assert spark.read.text(f"{folder}/*.csv").rdd.getNumPartitions() > 4
    got = sorted((os.path.basename(r.file).removesuffix(".csv"), r.line, r.value) for r in lines.collect())
    assert got == sorted((n, k, v) for n, rows in content.items() for k, v in enumerate(rows, 1) if k >= first and (last is None or k <= last))


def test_region_has_an_end(spark, small_stretches, sheets):
    folder, _ = sheets
    cells = read_region(spark, [f"{folder}/one.csv", f"{folder}/two.csv"], "'Clients'!B3:C200")
    assert cells.columns == ["source_file", "row", "label", "value"]
    got = sorted((os.path.basename(r.source_file), r.row, r.label, r.value) for r in cells.collect())
    assert got == sorted((f, k, f"row {k}", None if k % 7 == 0 else str(k * 2)) for f in ("one.csv", "two.csv") for k in range(4, 201))
    open_end = read_region(spark, f"{folder}/one.csv", "A5", header=False)
    assert open_end.columns[2:] == ["A", "B", "C"] and open_end.count() == 397
    assert read_region(spark, f"{folder}/three.csv", "A3:C9").count() == 2
    with pytest.raises(ValueError, match="different headers"):
        read_region(spark, f"{folder}/*.csv", "A5:C9")
    with pytest.raises(ValueError, match="no file has a row"):
        read_region(spark, f"{folder}/three.csv", "A50:C60")
    with pytest.raises(FileNotFoundError):
        read_region(spark, f"{folder}/none.csv", "A1:B2")


# Stored tables

KEYED = StructType([StructField("id", LongType()), StructField("label", StringType()), StructField("parent", LongType()), StructField("value", DoubleType())])
RULES = {
    "parent": Constraints(unique=[["id"]], required=["id", "label"]),
    "child": Constraints(unique=[["id"], ["label"]], references={"parent": ("parent", "id")}),
}


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, f"file://{tmp_path}/store", {"parent": KEYED, "child": KEYED})


def frame(spark, rows):
    return spark.createDataFrame(rows, KEYED)


def test_load_checks_keys_references_and_missing_values(spark, store):
    assert store.current() == (0, {}) and store.read("parent").count() == 0
    store.load({"parent": frame(spark, [(1, "a", None, 1.0), (2, "b", None, 2.0)]), "child": frame(spark, [(1, "x", 1, 0.5), (2, "y", None, 0.5)])}, RULES)
    bad = {"parent": frame(spark, [(3, None, None, None), (2, "again", None, None)]), "child": frame(spark, [(3, "x", 3, None), (4, "z", 9, None), (5, "w", 9, None)])}
    with pytest.raises(ConstraintError) as refused:
        store.load(bad, RULES)
    assert refused.value.broken == [("child", "parent references parent", 2), ("child", "unique label", 2), ("parent", "required label", 1), ("parent", "unique id", 2)]
    assert store.current()[0] == 1 and store.read("parent").count() == 2 and store.read("child").count() == 2
    # Parents and children of one load may refer to each other.
    store.load({"child": frame(spark, [(3, "z", 3, None)]), "parent": frame(spark, [(3, "c", None, None)])}, RULES)
    assert sorted(r.id for r in store.read("child").collect()) == [1, 2, 3]


def test_readers_see_all_tables_of_a_load_or_none(spark, store, monkeypatch):
    store.load({"parent": frame(spark, [(1, "a", None, None)]), "child": frame(spark, [(1, "x", 1, None)])}, RULES)
    whole, done = store.stage, []

    def dies(name, df):
        if done:
            raise RuntimeError("lost between two tables")
        done.append(name)
        return whole(name, df)

    monkeypatch.setattr(store, "stage", dies)
    with pytest.raises(RuntimeError):
        store.load({"parent": frame(spark, [(2, "b", None, None)]), "child": frame(spark, [(2, "y", 2, None)])}, RULES)
    monkeypatch.undo()
    assert store.read("parent").count() == store.read("child").count() == 1
    # Nothing is doubled when the load is repeated.
    store.load({"parent": frame(spark, [(2, "b", None, None)]), "child": frame(spark, [(2, "y", 2, None)])}, RULES)
    assert store.read("parent").count() == store.read("child").count() == 2


def test_two_loads_cannot_publish_the_same_version(spark, store):
    version, tables = store.current()
    new = {"parent": store.stage("parent", frame(spark, [(1, "a", None, None)]))}
    assert store.publish(version, new) == 1
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        store.publish(version, tables)
    assert store.read("parent").count() == 1


def test_upsert_rewrites_touched_buckets_only(spark, store):
    store.upsert("parent", frame(spark, [(k, f"row {k}", 1, 0.0) for k in range(200)]), ["id"], "parent", ["label"], buckets=8)
    before = store.current()[1]["parent"].by_bucket
    touched = store.upsert("parent", frame(spark, [(5, "new", 2, 1.0), (5, "older", 0, 9.0), (6, "stale", 0, 9.0)]), ["id"], "parent", ["label"])
    after = store.current()[1]["parent"].by_bucket
    assert len(before) == 8 and 1 <= len(touched) <= 2
    assert {b for b in after if after[b] != before[b]} == set(map(str, touched))
    rows = {r.id: (r.label, r.parent) for r in store.read("parent").collect()}
    assert len(rows) == 200 and rows[5] == ("new", 2) and rows[6] == ("row 6", 1)
    assert store.upsert("parent", frame(spark, []), ["id"], "parent", ["label"]) == [] and store.read("parent").count() == 200
    store.load({"child": frame(spark, [(1, "x", 5, None)])}, RULES)
    with pytest.raises(ValueError):
        store.upsert("child", frame(spark, [(1, "y", 5, None)]), ["id"], "value", ["label"])


def test_ids_go_on(spark, tmp_path):
    kinds = StructType([StructField("id", LongType()), StructField("year", LongType()), StructField("unit", StringType())])
    store = Warehouse(spark, f"file://{tmp_path}/ids", {"dim": kinds})

    def load(rows):
        return {(r.year, r.unit, r.note): r.id for r in store.number("dim", spark.createDataFrame(rows, "year long, unit string, note string"), "year", ["unit"]).collect()}

    first = load([(2000, "a", "n"), (2000, "b", "n"), (1999, None, "n"), (2000, "a", "twice")])
    assert sorted(set(first.values())) == [1, 2, 3] and first[2000, "a", "n"] == first[2000, "a", "twice"] and first[1999, None, "n"] == 1
    second = load([(1990, "z", "n"), (2000, "a", "n"), (1999, None, "n"), (2001, "c", "n")])
    assert second[2000, "a", "n"] == first[2000, "a", "n"] and second[1999, None, "n"] == 1
    assert (second[1990, "z", "n"], second[2001, "c", "n"]) == (4, 5)
    assert load([]) == {}
