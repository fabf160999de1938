"""Correlations, regrouped results and two-level files against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fulltime.operators.correlation import correlation_matrix
from fulltime.operators.numbering import numbered
from fulltime.session import scratch_dir
from fulltime.sources import raw


def test_correlations_leave_out_rows_as_a_whole(spark):
    r = random.Random(1)
    rows = []
    for i in range(3000):
        x = r.gauss(0, 1)
        rows.append((x + 1e6, 2 * x + r.gauss(0, 1), None if i % 7 == 0 else r.gauss(0, 1), float("nan") if i % 11 == 0 else -x, 4.0, i))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f long")
    got = {(p["col_a"], p["col_b"]): p["corr"] for p in correlation_matrix(df.repartition(9), list("abcdf")).collect()}
    kept = np.array([(*x[:4], x[5]) for x in rows if x[2] is not None and x[3] == x[3]], float)
    want = np.corrcoef(kept.T)
    assert len(got) == 10
    for i, a in enumerate("abcdf"):
        for j, b in enumerate("abcdf"):
            if i < j:
                assert got[a, b] == pytest.approx(want[i, j], abs=1e-9)
    flat = correlation_matrix(df, ["a", "e"]).first()
    assert flat["corr"] is None and flat["rows"] == 3000
    assert correlation_matrix(df.limit(0), ["a", "b"]).first()["corr"] is None
    assert correlation_matrix(df.limit(1), ["a", "b"]).first()["corr"] is None
    assert correlation_matrix(df, []).collect() == correlation_matrix(df, ["a"]).collect() == []


def test_numbers_over_ranges_without_one_window(spark):
    df = spark.range(20_000).select((F.rand(3) * 50).cast("int").alias("k"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("v"))
    out = numbered(df.repartition(6), ["k", "v"], "n", first=1)
    rows = out.collect()
    assert sorted(r["n"] for r in rows) == [*range(1, 20_001)]
    rows.sort(key=lambda r: r["n"])
    key = lambda r: (r["k"], r["v"] is not None, r["v"] or 0)
    assert all(key(a) <= key(b) for a, b in zip(rows, rows[1:]))
    assert numbered(df.limit(0), ["k"]).count() == 0


def test_rounds_stand_in_order_of_appearance(spark):
    kind = ("edition string, pos int, `group` string, round string, date string, team1 string, team2 string, "
            "goals1 array<struct<name:string,minute:int>>, goals2 array<struct<name:string,minute:int>>")
    rows = [("a", 1, "Group B", "Matchday 1", "d", "X", "Y", [("p", 3), (None, None)], [("q", 9)]), ("a", 2, None, "Final", "d", "X", "Y", None, []),
            ("a", 3, "Group B", None, "d", "Y", "X", [], [("p", 1)]), ("a", 4, None, None, "d", None, "X", [("o", 5)], None),
            (None, 1, None, "Final", "d", "U", "V", None, None), ("b", 7, None, "Final", "d", "U", "V", None, None)]
    out = raw.regroup_rounds(spark.createDataFrame(rows, kind).repartition(3), ["pos"])
    got = {(r["edition"], r["num"]): (r["round_label"], r["round_place"], [tuple(g) for g in r["goals"]]) for r in out.collect()}
    assert got == {("a", 1): ("Group B", 1, [("p", "X", 3), ("", "X", 0), ("q", "Y", 9)]), ("a", 2): ("Final", 2, []), ("a", 3): ("Group B", 1, [("p", "X", 1)]),
                   ("a", 4): ("Unknown", 3, [("o", "", 5)]), (None, 1): ("Final", 1, []), ("b", 1): ("Final", 1, [])}


def test_header_names():
    assert raw.header_names(["", "", "Perf", "", "Exp"], ["Player", "Squad", "Gls", "Ast", "xG"]) == ["Player", "Squad", "Perf_Gls", "Perf_Ast", "Exp_xG"]
    assert raw.header_names(["Unnamed: 0_level_0", "A", "Unnamed: 2_level_0", ""], ["P", "x", "Unnamed: 2_level_1", "y"]) == ["P", "A_x", "column_3", "y"]
    assert raw.header_names(["A", "", "B"], ["x", "x", "x", "z"]) == ["A_x", "A_x__2", "B_x", "B_z"]


def test_two_level_files(spark):
    path = scratch_dir(spark, "two-level")
    head = ",,Perf,\nPlayer,Squad,Gls,xG\n"
    text = head + '"Ann, Jr",S1,3,1.5\nBob,,x,\n' + head + "Cy,S2,4,0.25\n\n"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    other = scratch_dir(spark, "two-level")
    spark.createDataFrame([("Misc,\nPlayer,Red\nDi,1\n",)], "value string").coalesce(1).write.text(other)
    df = raw.read_leagues(spark, {"one": path, "two": other}, text=["Player", "Misc_Player", "Squad"])
    assert df.columns == ["Player", "Squad", "Perf_Gls", "Perf_xG", "league", "Misc_Player", "Misc_Red"]
    assert {tuple(r) for r in df.collect()} == {("Ann, Jr", "S1", 3.0, 1.5, "one", None, None), ("Bob", None, None, None, "one", None, None),
                                                ("Cy", "S2", 4.0, 0.25, "one", None, None), (None, None, None, None, "two", "Di", 1.0)}
    empty = scratch_dir(spark, "two-level")
    spark.createDataFrame([("one line",)], "value string").write.text(empty)
    with pytest.raises(ValueError, match="header"):
        raw.read_two_level(spark, empty)
