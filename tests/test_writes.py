"""Tables and files that are replaced as a whole or not at all."""

from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from atlasmith import writes
from atlasmith.operators import quality
from atlasmith.sources import snapshots
from atlasmith.sources import tables as T

SF = "/root/testdata/sf0.001"
broken = lambda: F.raise_error(F.lit("broken write")).cast("long")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_table_is_replaced_from_itself_and_kept_by_a_broken_write(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.read_snapshot(spark, path) is None
    with pytest.raises(FileNotFoundError):
        T.read_stage_parquet(spark, path)
    first = T.refresh_table(spark.range(5), path)
    T.refresh_table(first.selectExpr("id + 10 AS id"), path)
    assert rows(T.read_stage_parquet(spark, path)) == [(i,) for i in range(10, 15)]
    assert rows(first) == [(i,) for i in range(5)]  # Readers of the version before go on.
    with pytest.raises(Exception, match="broken write"):
        T.refresh_table(spark.range(9).select(F.when(F.col("id") == 7, broken()).otherwise(F.col("id")).alias("id")), path)
    assert rows(T.read_stage_parquet(spark, path)) == [(i,) for i in range(10, 15)]
    for k in range(4):
        T.refresh_table(spark.range(k), path)
    assert len(snapshots.names(spark, f"{path}/commits")) == snapshots.KEPT
    assert rows(T.refresh_table(spark.range(0), path)) == []


def test_two_writers_do_not_both_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    T.refresh_table(spark.range(3), path)
    number = snapshots.current(spark, path)[0]
    T.refresh_table(spark.range(4), path)
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, path, number, {"": "other"}, spark.range(1).schema)
    assert snapshots.read_snapshot(spark, path).count() == 4


def test_a_merge_leaves_untouched_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(200).selectExpr("id AS key", "1L AS ts", "'old' AS value")
    T.merge_latest(table, path, "key", "ts", 8)
    before = snapshots.current(spark, path)[1]["folders"]
    new = spark.createDataFrame([(5, 2, "new"), (5, 3, "newest"), (7, 0, "late"), (7, 1, "same time"), (1000, 1, "more")], table.schema)
    out = T.merge_latest(new, path, "key", "ts", 8)
    after = snapshots.current(spark, path)[1]["folders"]
    touched = {str(r[0]) for r in new.select(snapshots.bucket_of(["key"], 8)).collect()}
    assert {b for b in after if before.get(b) != after[b]} == touched and len(touched) < len(after)
    got = {r["key"]: r["value"] for r in out.collect()}
    assert len(got) == out.count() == 201 and (got[5], got[7], got[1000], got[8]) == ("newest", "same time", "more", "old")
    assert rows(T.merge_latest(new.limit(0), path, "key", "ts", 8)) == rows(out)


def test_months_are_written_once(spark, tmp_path):
    path = str(tmp_path / "grid")
    grid = spark.createDataFrame([(m, f"r{i}", i) for m in (202601, 202602, 202603) for i in range(4)], "month int, repo_name string, n long")
    assert snapshots.read_months(spark, path, grid.schema).count() == 0
    assert rows(T.materialize_months(grid.where("month < 202602"), path)) == [(202601,)]
    # A run that breaks after some rows of a month.
    grid.where("month = 202602 and n < 2").write.partitionBy("month").mode("append").parquet(f"{path}/rows")
    assert snapshots.read_months(spark, path, grid.schema).count() == 4
    assert rows(T.materialize_months(grid, path)) == [(202602,), (202603,)]
    assert rows(T.materialize_months(grid, path)) == []
    assert rows(snapshots.read_months(spark, path, grid.schema)) == rows(grid)
    with pytest.raises(Exception, match="broken write"):
        T.materialize_months(grid.withColumns({"month": F.lit(202604), "n": broken()}), path)
    assert rows(snapshots.read_months(spark, path, grid.schema)) == rows(grid)


def test_private_data_stops_a_publication(spark, tmp_path):
    path = str(tmp_path / "site")
    pages = spark.createDataFrame([("country", "no/1 ü", '{"name":"Norway"}'), ("city", "no-oslo", '{"name":"Oslo"}')], "geo_level string, file string, payload string")
    good = rows(T.publish_json(pages, path, quality.privacy_scan))
    assert good == [("city", "no-oslo", '{"name":"Oslo"}'), ("country", "no/1 ü", '{"name":"Norway"}')]
    bad = pages.withColumn("payload", F.concat("payload", F.lit(" by a.b@example.org")))
    with pytest.raises(snapshots.PrivateData) as stopped:
        T.publish_json(bad, path, quality.privacy_scan)
    assert stopped.value.violations == 2 and rows(snapshots.read_files(spark, path)) == good
    assert len(snapshots.names(spark, f"{path}/data")) == 1
    assert rows(T.publish_json(pages.limit(1), path, quality.privacy_scan)) == good[1:]
    assert rows(T.publish_json(pages.limit(0), path, quality.privacy_scan)) == []


def test_failing_rows_are_counted_at_the_write_and_kept_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    tests = {"negative": (F.col("n") < 0, "n is not negative"), "twice": (quality.key_test(["key"]), "key unique")}
    table = spark.createDataFrame([("a", 1), ("b", 2)], "key string, n long")
    out, failing = quality.write_checked(table, tests, path)
    assert rows(out) == [("a", 1), ("b", 2)] and failing == {"negative": 0, "twice": 0}
    bad = spark.createDataFrame([("a", -1), ("b", None), ("c", 1), ("c", 1), ("c", 1)], table.schema)
    with pytest.raises(quality.ChecksFailed, match="negative") as stopped:
        quality.write_checked(bad, tests, path)
    assert stopped.value.failing == {"negative": 1, "twice": 1} and rows(snapshots.read_snapshot(spark, path)) == [("a", 1), ("b", 2)]
    assert sorted((r["key"], list(r["failed_checks"])) for r in spark.read.parquet(stopped.value.quarantine).collect()) == [("a", ["negative"]), ("c", ["twice"])]
    empty, failing = quality.write_checked(table.limit(0), tests, path)
    assert empty.count() == 0 and set(failing.values()) == {0}


def test_contracts_find_missing_and_other_columns(spark):
    df = spark.createDataFrame([("a", 5, "x"), (None, -1, "y")], "name string, n long, more string")
    found = {r["check_name"]: r["failing_rows"] for r in quality.check_schema_contract(df, {"name": "text", "n": "count", "score": "score?"}).collect()}
    assert found == {"name": 1, "n": 1, "score": 2, "more": 2}


def test_a_cluster_must_name_its_shared_folder():
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="shares"):
        snapshots.shared_dir(session)


@pytest.mark.parametrize("name", ["materialize_months", "refresh_table", "upsert_latest", "publish_json", "privacy_gate", "quality_gate", "check_schema_contract", "check_rankings", "check_score_bounds", "export_candidates"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df, want = writes.QUERIES[name](spark, SF), con.sql(writes.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    plain = lambda x: round(x, 3) + 0.0 if isinstance(x, float) else x.isoformat()[:10] if hasattr(x, "isoformat") else x
    assert sorted(repr([plain(r[c]) for c in columns]) for r in df.collect()) == sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())
