"""Stored tables lose no row: overwrite, append and upsert in any order."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fulltime.sources.layer import Layer


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def content(layer, name="t"):
    return sorted((r["k"], r["v"]) for r in layer.read(name).collect())


def test_overwrite_upsert_append_upsert(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    layer.overwrite(rows(spark, *[(i, "a") for i in range(10)]), "t")
    layer.upsert(rows(spark, (1, "b"), (20, "b")), "t", ["k"])
    want = {i: "a" for i in range(10)} | {1: "b", 20: "b"}
    assert content(layer) == sorted(want.items())
    layer.append(rows(spark, (30, "c")), "t")
    assert content(layer) == sorted((want | {30: "c"}).items())
    layer.upsert(rows(spark, (30, "d"), (2, "d")), "t", ["k"])
    assert content(layer) == sorted((want | {30: "d", 2: "d"}).items())


def test_an_upsert_rewrites_only_partitions_it_touches(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    layer.upsert(rows(spark, *[(i, "a") for i in range(200)]), "t", ["k"], parts=16)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("*/*.parquet")}
    layer.upsert(rows(spark, (5, "b")), "t", ["k"])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("*/*.parquet")}
    assert 0 < len({p.parent for p in before if p not in after}) == 1
    assert all(after[p] == t for p, t in before.items() if p in after)
    assert layer.read("t").count() == 200


def test_new_columns_and_key_types(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    layer.upsert(rows(spark, (1, "a"), (2, "a")), "t", ["k"])
    layer.upsert(rows(spark, (2, "b")).withColumn("w", F.lit(7)), "t", ["k"])
    got = {r["k"]: (r["v"], r["w"]) for r in layer.read("t", merge_schema=True).collect()}
    assert got == {1: ("a", None), 2: ("b", 7)}
    with pytest.raises(ValueError):
        layer.upsert(rows(spark, (1, "a")), "t", ["v"])


def test_a_source_is_read_once(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    source = rows(spark, (1, "a")).withColumn("v", F.expr("uuid()"))
    layer.upsert(source, "t", ["k"])
    layer.upsert(source, "t", ["k"])
    assert layer.read("t").count() == 1


def test_a_table_that_cannot_be_read_is_an_error(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        layer.upsert(rows(spark, (1, "a")), "t", ["k"])
    assert (tmp_path / "t" / "part-0.parquet").read_text() == "not parquet"
    with pytest.raises(AnalysisException):
        layer.read("absent")


def test_categories(spark, tmp_path):
    from fulltime.sources import raw

    rows(spark, (1, "a")).write.parquet(str(tmp_path / "there"))
    paths = {"there": str(tmp_path / "there"), "missing": str(tmp_path / "missing")}
    assert list(raw.read_categories(spark, paths, optional=True)) == ["there"]
    with pytest.raises(AnalysisException):
        raw.read_categories(spark, paths)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no")
    with pytest.raises(Exception):
        raw.read_categories(spark, {"broken": str(tmp_path / "broken")}, optional=True)


def test_malformed_and_array_documents(spark, tmp_path):
    from pyspark.sql.types import StructType

    from fulltime.sources import raw

    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2, broken\n{"id": 3}\n')
    schema = StructType.fromDDL("id long")
    for _ in range(2):  # the caller's schema stays as it is
        docs = raw.read_json_docs(spark, str(tmp_path / "a.json"), schema).cache().collect()
        assert [r["id"] for r in docs if r["_corrupt_record"] is None] == [1, 3]
        assert sum(r["_corrupt_record"] is not None for r in docs) == 1
    with pytest.raises(Exception):
        raw.read_json_docs(spark, str(tmp_path / "a.json"), schema, keep_corrupt=False).collect()
    (tmp_path / "b.json").write_text('[{"id": 5},\n {"id": 6}]')
    assert sorted(r["id"] for r in raw.read_json_docs(spark, str(tmp_path / "b.json"), schema, multiline=True).collect()) == [5, 6]


def test_partition_reload_and_overwrite_of_a_keyed_table(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    kind = "k long, day string, v string"
    layer.upsert(spark.createDataFrame([(i, None if i % 4 == 3 else f"d{i % 4}", "a") for i in range(40)], kind), "t", ["k"])
    layer.replace_partitions(spark.createDataFrame([(1, "d1", "b"), (99, None, "b")], kind), "t", ["day"])
    got = {r["k"]: (r["day"], r["v"]) for r in layer.read("t").collect()}
    assert got == {i: (f"d{i % 4}", "a") for i in range(40) if i % 4 in (0, 2)} | {1: ("d1", "b"), 99: (None, "b")}
    layer.upsert(spark.createDataFrame([(1, "d1", "c")], kind), "t", ["k"])
    layer.overwrite(spark.createDataFrame([(5, "d1", "d"), (6, "d1", "d")], kind), "t")
    layer.upsert(spark.createDataFrame([(6, "d1", "e")], kind), "t", ["k"])
    assert sorted((r["k"], r["v"]) for r in layer.read("t").collect()) == [(5, "d"), (6, "e")]
    layer.overwrite(spark.createDataFrame([("x",)], "other string"), "t")  # rows without the key: a plain table
    assert layer.read("t").columns == ["other"]


def test_null_keys_and_odd_key_names(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    keys = ["a__b", "_c", "d_", "e~f", "plain_key"]
    kind = ", ".join(f"`{k}` string" for k in keys) + ", v string"
    for v in "pqr":
        layer.upsert(spark.createDataFrame([(None, "x", "x", "x", "x", v), (None, None, None, None, None, v), ("1", "x", None, "x", "x", v)], kind), "t", keys)
    assert [r["v"] for r in layer.read("t").collect()] == ["r"] * 3
    assert set(layer.read("t").columns) == {*keys, "v"}
    with pytest.raises(ValueError, match="duplicate"):
        layer.upsert(spark.createDataFrame([(None, None, None, None, None, "s")] * 2, kind), "t", keys)


def test_nothing_staged_is_left(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    for i in range(3):
        layer.upsert(rows(spark, (i, "a"), (7, "b")), "t", ["k"])
    with pytest.raises(ValueError):
        layer.upsert(rows(spark, (1, "a"), (1, "b")), "t", ["k"])
    layer.replace_partitions(rows(spark, (1, "c")), "t", ["v"])
    assert layer.folders("_staging") == [] and layer.folders("none") == []


def test_audit_while_writing_is_one_job(spark, tmp_path):
    from fulltime.operators.reports import null_audit

    layer = Layer(spark, str(tmp_path))
    df = spark.createDataFrame([(i, None if i % 3 else "x", None) for i in range(100)], "k long, v string, `odd.name` string")
    layer.overwrite(df, "source")
    spark.sparkContext.setJobGroup("audited", "")
    try:
        audit = layer.overwrite_audited(layer.read("source"), "copy")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("audited")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # the reader's look at one file's schema, the write
    assert audit.first().asDict() == {"rows": 100, "nulls_k": 0, "nulls_v": 66, "nulls_odd.name": 100}
    assert audit.select("rows", "nulls_k", "nulls_v").first() == null_audit(layer.read("copy"), ["k", "v"]).first()


def test_a_partition_is_not_written_by_every_task(spark, tmp_path):
    layer, many = Layer(spark, str(tmp_path)), spark.range(6000).select("id", (F.col("id") % 3).alias("p")).repartition(24)
    files = lambda name: len(list((tmp_path / name).glob("*/*.parquet")))
    layer.overwrite(many, "t", ["p"])
    assert files("t") == 3 and layer.read("t").count() == 6000
    layer.upsert(many, "u", ["id"], parts=4)
    layer.upsert(many.withColumn("p", F.lit(9)), "u", ["id"])
    layer.append(many.withColumn("id", F.col("id") + 6000), "u")
    assert files("u") == 8 and layer.read("u").count() == 12_000 and layer.read("u").where("p = 9").count() == 6000


def test_a_match_is_one_file_whatever_the_order_of_its_events(spark, tmp_path):
    from fulltime.plans import io

    events = spark.range(4000).select((F.col("id") % 20).alias("match_id"), "id").repartition(16)
    io._per_match(events).json(str(tmp_path / "e"))
    files = list((tmp_path / "e").glob("match_id=*/*.json"))
    assert len(files) == 20 and sum(len(f.read_text().splitlines()) for f in files) == 4000
