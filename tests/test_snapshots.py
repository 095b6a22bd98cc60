"""Differences, history, quarantine, JSON arrays, versions and incremental runs."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart import schema
from docmart.operators import history
from docmart.plans import medallion
from docmart.session import checkpoint_base, materialize, scratch
from docmart.sources import json_array, landing, quarantine, versions
from docmart.streaming import upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_difference_with_null_keys_and_nulls(spark):
    cols = "k int, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, None, 2), (None, "n", 3), (4, "d", 4)], cols)
    new = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (None, None, 3), (5, "i", 5)], cols)
    diff = history.snapshot_diff(old, new, ["k"])
    assert rows(diff) == sorted([("update", 2, "y", 2), ("update", None, None, 3), ("delete", 4, "d", 4), ("insert", 5, "i", 5)], key=repr)
    assert rows(history.apply_diff(old, diff, ["k"])) == rows(new)
    assert history.snapshot_diff(old, old, ["k"]).count() == 0


def test_validity_against_a_plain_walk(spark):
    rng, data = random.Random(3), []
    for key in (*range(40), None):
        for day in range(1, 9):
            if rng.random() < 0.75:
                data.append((key, rng.choice(["a", "b", None]), day))
    days, want = sorted({d for _, _, d in data}), []
    for key in (*range(40), None):
        held = {d: v for k, v, d in data if k == key}
        begin = None
        for i, d in enumerate([*days, None]):
            if begin is not None and (d is None or d not in held or held[d] != held[begin]):
                want.append((key, held[begin], begin, d))
                begin = None
            if d in held and begin is None:
                begin = d
    got = history.validity(spark.createDataFrame(data, "k int, v string, day int"), ["k"], "day")
    assert rows(got) == sorted(want, key=repr)


SHAPE = T.StructType([T.StructField("id", T.StringType()), T.StructField("o", T.StructType([
    T.StructField("xs", T.ArrayType(T.StructType([T.StructField("n", T.StringType())])))]))])


def test_every_line_is_good_or_quarantined(spark, tmp_path):
    lines = {'{"id":"1","o":{"xs":[{"n":"a"}]}}': [], '{"id":2,"o":null}': [], '{"id":"3","o":[]}': ["o: struct expected"],
             '{"id":"4","o":{"xs":{"n":"a"}}}': ["o.xs: array expected"], '{"id":"5","o":{"xs":[1,{"n":2}]}}': ["o.xs[]: struct expected"],
             '{"id":"6"': ["malformed"], "[1]": ["no object"], '{"other":1}': []}
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n\n")
    good, bad = quarantine.split(spark, str(tmp_path), SHAPE)
    assert {r.raw: r.reasons for r in bad.collect()} == {k: v for k, v in lines.items() if v}
    assert sorted((r.id or "") for r in good.collect()) == ["", "1", "2"]
    assert {r.reason: r.records for r in quarantine.counts(bad).collect()}["malformed"] == 1
    assert good.count() + bad.count() == len(lines)


@pytest.mark.parametrize("split", ["128m", "64"])
def test_json_arrays_at_any_split_size(spark, tmp_path, split):
    rng = random.Random(4)
    text = lambda: "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "ñ", "x", "\n"]) for _ in range(rng.randrange(12)))
    data = [{"id": str(i), "o": {"xs": [{"n": text()} for _ in range(rng.randrange(3))]}} for i in range(60)]
    (tmp_path / "one.json").write_text(json.dumps(data), encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps(data, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "none.json").write_text("[]")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = json_array.read_json_array(spark, str(tmp_path), SHAPE).collect()
        if split == "64":
            assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 50
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    mine = sorted((r.id, tuple(x.n for x in r.o.xs)) for r in got)
    assert mine == sorted((d["id"], tuple(x["n"] for x in d["o"]["xs"])) for d in data * 2)


def test_a_failed_publish_leaves_the_former_version(spark, tmp_path):
    root, df = str(tmp_path / "v"), spark.range(3)
    assert versions.published(spark, root) == {}
    versions.publish_all(spark, {f"t{i}": df for i in range(16)}, root, "2024-01-01 00:00:00")

    def refuse(name, written):
        if name == "t9":
            raise RuntimeError("ninth")

    with pytest.raises(RuntimeError, match="ninth"):
        versions.publish_all(spark, {f"t{i}": spark.range(9) for i in range(16)}, root, check=refuse)
    assert {t.count() for t in versions.published(spark, root).values()} == {3}
    versions.publish_all(spark, {"t0": spark.range(5)}, root)
    assert versions.manifest(spark, root)["number"] == 1 and versions.published(spark, root)["t0"].count() == 5
    assert versions.published(spark, root, 0)["t9"].count() == 3
    assert len(versions.vacuum(spark, root, keep=1)) == 2 and versions.published(spark, root)["t0"].count() == 5


def record(rid, title, changed="1"):
    return (rid, title, changed)


def land(spark, root, at, records):
    df = spark.createDataFrame(records, "id string, title string, changed string")
    landing.land_json(df, root, at)


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_incremental_runs_equal_a_full_run_and_leave_other_buckets(spark, tmp_path):
    root, run = str(tmp_path / "raw"), None
    run = upsert.Upsert(spark, root, str(tmp_path / "t"), buckets=16)
    land(spark, root, "2024-01-01 00:00:00", [record(str(i), "old") for i in range(40)] + [record(None, "no id")])
    run.run()
    before = files(tmp_path / "t/records")
    land(spark, root, "2024-01-02 00:00:00", [record("3", "new"), record("99", "more"), record(None, "no id")])
    run.run()
    full = medallion.raw_to_staging(spark, root)["tipo_tramite"]
    mine = run.staging()["tipo_tramite"]
    assert rows(mine.select(*full.columns)) == rows(full) and mine.filter("TITULO_TIPO_TRAMITE = 'new'").count() == 1
    after = files(tmp_path / "t/records")
    gone = {f.split("/")[0] for f in before - after}
    assert gone == {f"bucket={b}" for b in {spark.range(1).select(upsert.bucket(F.lit("3"), 16, 0)).first()[0],
                                             spark.range(1).select(upsert.bucket(F.lit("99"), 16, 0)).first()[0]}} & {f.split("/")[0] for f in before}
    # Delivered again, whole or under a number already done: nothing changes.
    again = landing.scan_json(spark, root, schema.RAW_SCHEMA)
    run.take(again, 1)
    run.take(again, 77)
    assert files(tmp_path / "t/records") == after and run.staging()["tramites_base"].filter("CODIGO_TRAMITE is null").count() == 1


def scratch_folders(spark):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_base(spark))
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return {f.getPath().getName() for f in there}


def test_scratch_removes_what_was_made_inside(spark):
    df = spark.range(3).toDF("id")
    outer = materialize(df, "outside")
    before = scratch_folders(spark)
    with scratch(spark):
        one = materialize(df, "one")
        with scratch(spark):
            materialize(one, "two")
            assert len(scratch_folders(spark) - before) == 2
        assert one.count() == 3 and len(scratch_folders(spark) - before) == 1
    assert scratch_folders(spark) == before and outer.count() == 3
    with pytest.raises(ValueError):
        with scratch(spark):
            materialize(df, "fails")
            raise ValueError
    assert scratch_folders(spark) == before


def test_incremental_runs_leave_no_intermediate_tables(spark, tmp_path):
    root = str(tmp_path / "raw")
    land(spark, root, "2024-01-01 00:00:00", [record(str(i), "old") for i in range(3)])
    before = scratch_folders(spark)
    run = upsert.Upsert(spark, root, str(tmp_path / "t"), buckets=4)
    run.run()
    assert run.staging()["tipo_tramite"].count() == 3 and scratch_folders(spark) == before
