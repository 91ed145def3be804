"""Interval join, page chains, checked CSV, counts by file and by batch, quantiles of large groups."""

from __future__ import annotations

import random

import numpy as np
import pytest

from signalweave.operators.intervals import interval_join
from signalweave.operators.pages import chain_pages
from signalweave.operators.series import range_quantiles
from signalweave.session import shared_folder
from signalweave.sources.checked_csv import FIELDS, VALUES, good_rows, read_csv_checked, rejected_rows
from signalweave.sources.manifest import count_new_files, folded_counts, pending_files
from signalweave.sources.readers import read_result_pages
from signalweave.streaming.deltas import compact, delta_writer, read_counts


def test_interval_join_equals_brute_force(spark):
    draw = random.Random(3)
    points = [(i, draw.choice([None, 5, draw.randrange(-1000, 100_000), draw.randrange(-(1 << 62), 1 << 62)])) for i in range(400)]
    points += [(1000 + i, 5) for i in range(300)]
    ranges = [(i, a, a + draw.choice([-3, 0, 1, 2, 3, 64, 1000, 50_000])) for i, a in enumerate(draw.randrange(-2000, 100_000) for _ in range(200))]
    ranges += [(900, None, 7), (901, 3, None), (902, 5, 6), (903, 0, 8), (904, 0, 8), (905, -(1 << 62), 1 << 62), (906, 6, 6)]
    p = spark.createDataFrame(points, "p INT, t BIGINT")
    r = spark.createDataFrame(ranges, "r INT, a BIGINT, b BIGINT")
    joined = interval_join(p, r, "t", "a", "b")
    got = sorted((x["p"], x["r"]) for x in joined.collect())
    wanted = sorted((i, j) for i, t in points for j, a, b in ranges if None not in (t, a, b) and a <= t < b)
    assert got == wanted and joined.columns == ["p", "t", "r", "a", "b"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = interval_join(p, r, "t", "a", "b")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(p, r.limit(0), "t", "a", "b").count() == 0


def test_interval_join_of_days_and_times(spark):
    p = spark.sql("SELECT 1 AS p, timestamp'2024-01-31 23:59:59.999999' AS t UNION ALL SELECT 2, timestamp'2024-02-01 00:00:00'")
    r = spark.sql("SELECT 7 AS r, date'2024-01-01' AS a, date'2024-02-01' AS b")
    assert [(x["p"], x["r"]) for x in interval_join(p, r, "t", "a", "b").collect()] == [(1, 7)]


def test_page_chains(spark):
    pages = [("a", None, "t1"), ("a", "t1", "t2"), ("a", "t2", None), ("a", "t1", "t2"), ("a", "t1", None)]
    pages += [("b", "x", "y"), ("b", "y", "z"), ("b", "z", "gone"), ("b", "p", "q"), ("b", "q", "p"), ("b", "r", "r")]
    pages += [(None, None, "n1"), (None, "n1", None)]
    pages += [("long", None if i == 0 else str(i), str(i + 1)) for i in range(300)]
    got = chain_pages(spark.createDataFrame(pages, "request STRING, token STRING, next_token STRING"), ["request"]).collect()
    rows = {(r["request"], r["token"]): (r["segment"], r["position"], r["copies"], r["status"], r["missing_next"]) for r in got}
    assert len(rows) == len(got) == len({(a, b or "") for a, b, _ in pages})
    assert rows["a", ""] == ("", 0, 1, "whole", False) and rows["a", "t1"] == ("", 1, 3, "whole", False)
    assert rows["a", "t2"] == ("", 2, 1, "whole", False)
    assert rows["b", "z"] == ("x", 2, 1, "cut", True) and rows["b", "x"][3] == "cut"
    assert {rows["b", t][:2] + rows["b", t][3:4] for t in "pqr"} == {(None, None, "loop")}
    assert rows[None, "n1"] == ("", 1, 1, "whole", False)
    assert all(rows["long", str(i) if i else ""] == ("", i, 1, "whole", i == 299) for i in range(300))


def test_pages_keep_their_meta(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"id": "1", "text": "x"}, {"id": "2"}], "meta": {"result_count": 2, "next_token": "n"}}\n')
    rows = read_result_pages(spark, str(tmp_path), meta=True).select("id", "result_count", "next_token").collect()
    assert [tuple(r) for r in rows] == [("1", 2, "n"), ("2", 2, "n")]
    assert "next_token" not in read_result_pages(spark, str(tmp_path)).columns


def test_checked_csv_numbers_lines_over_splits(spark, tmp_path):
    lines = ["id,price,name"]
    for i in range(3000):
        lines.append({3: f"{i},1.5,a,b", 5: f"{i},x,n", 6: "", 7: f"{i}"}.get(i % 10, f'{i},{i}.5,"n, {i}"'))
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.csv").write_text("id,price,name\n1,2.5,x")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        checked = read_csv_checked(spark, str(tmp_path), "id BIGINT, price DOUBLE, name STRING").cache()
        good, bad = good_rows(checked).collect(), rejected_rows(checked).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(good) + len(bad) == sum(bool(x) for x in lines[1:]) + 1
    assert {(r["line"], r["rejected"], r["reason"]) for r in bad} == {
        (n, x, VALUES if i % 10 == 5 else FIELDS) for n, (i, x) in enumerate(enumerate(lines[1:]), 2) if i % 10 in (3, 5, 7)
    }
    assert {r["name"] for r in good if r["id"] and r["id"] > 1} == {f"n, {i}" for i in range(2, 3000) if i % 10 not in (3, 5, 6, 7)}
    assert {r["line"] for r in checked.filter("file LIKE '%two.csv'").collect()} == {2}


KEYS = ["month", "country"]


def test_counts_by_file_read_new_and_changed_files_only(spark, tmp_path):
    landing, store = str(tmp_path / "in"), str(tmp_path / "store")

    def land(name, rows, mode="overwrite"):
        frame = spark.createDataFrame(rows, "id STRING, month STRING, country STRING")
        frame.coalesce(1).write.mode(mode).parquet(f"{landing}/{name}")

    def counts():
        return {(r["month"], r["country"]): r["id_count"] for r in folded_counts(spark, store, KEYS).collect()}

    land("a b", [("1", "m1", "x"), ("2", "m1", "x"), ("3", None, "x")])
    with pytest.raises(ValueError):
        counts()
    assert len(count_new_files(spark, landing, store, KEYS, lambda d: d)) == 1
    assert counts() == {("m1", "x"): 2}
    assert count_new_files(spark, landing, store, KEYS, lambda d: d) == []
    land("c", [("4", "m1", "x"), ("5", "m2", "y")])
    assert [f.split("/")[-2] for f in count_new_files(spark, landing, store, KEYS, lambda d: d)] == ["c"]
    assert counts() == {("m1", "x"): 3, ("m2", "y"): 1}
    # A run that fails before its manifest is written leaves partial counts that nothing names.
    land("d", [("6", "m3", "z")])
    spark.createDataFrame([("f", "m9", "q", 5)], "file STRING, month STRING, country STRING, id_count BIGINT").write.parquet(f"{store}/partials/run=17")
    assert counts() == {("m1", "x"): 3, ("m2", "y"): 1}
    assert [r["file"].split("/")[-2] for r in pending_files(spark, landing, store).collect()] == ["d"]
    count_new_files(spark, landing, store, KEYS, lambda d: d)
    assert counts() == {("m1", "x"): 3, ("m2", "y"): 1, ("m3", "z"): 1}
    # A file that changes in place counts by its latest state.
    path = next((tmp_path / "in" / "c").glob("part-*.parquet"))
    other = next((tmp_path / "in" / "d").glob("part-*.parquet"))
    path.write_bytes(other.read_bytes())
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    spark.catalog.refreshByPath(landing)
    assert len(count_new_files(spark, landing, store, KEYS, lambda d: d)) == 1
    assert counts() == {("m1", "x"): 2, ("m3", "z"): 2}


def test_deltas_replay_and_compaction(spark, tmp_path):
    target = str(tmp_path)

    def batch(number, rows):
        delta_writer(target, KEYS)(spark.createDataFrame(rows, "id STRING, month STRING, country STRING"), number)

    def counts():
        return {(r["month"], r["country"]): r["id_count"] for r in read_counts(spark, target, KEYS).collect()}

    batch(0, [("1", "m2", "x"), ("2", "m2", "x")])
    batch(1, [("3", "m1", "x")])
    batch(1, [("3", "m1", "x")])
    assert counts() == {("m2", "x"): 2, ("m1", "x"): 1}
    compact(spark, target, KEYS)
    compact(spark, target, KEYS)
    batch(1, [("3", "m1", "x")])
    assert counts() == {("m2", "x"): 2, ("m1", "x"): 1}
    batch(2, [("4", "m2", "x"), ("5", "m1", None)])
    assert counts() == {("m2", "x"): 3, ("m1", "x"): 1}
    compact(spark, target, KEYS)
    assert counts() == {("m2", "x"): 3, ("m1", "x"): 1}


def test_quantiles_by_range(spark):
    draw = random.Random(5)
    rows = [("big", draw.choice([1.0, 2.0, draw.random()])) for _ in range(3000)] + [("one", 4.0), ("two", 1.0), ("two", 2.0), (None, 3.0), ("big", None), ("none", None)]
    got = {r["g"]: r for r in range_quantiles(spark.createDataFrame(rows, "g STRING, v DOUBLE"), ["g"], "v").collect()}
    assert set(got) == {"big", "one", "two"}
    for g, r in got.items():
        values = [v for k, v in rows if k == g and v is not None]
        assert r["n"] == len(values)
        assert np.allclose([r["q25"], r["q50"], r["q75"]], np.percentile(values, [25, 50, 75]))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        folder = None

        def get(self, *_):
            return self.folder

    class Context:
        master = "spark://head:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="shared folder"):
        shared_folder(Session(), "x")
    Context.master = "local[2]"
    assert shared_folder(Session(), "x")
    Conf.folder = "hdfs:/shared/"
    Context.master = "yarn"
    assert shared_folder(Session(), "x").startswith("hdfs:/shared/x-")
