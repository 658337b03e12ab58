"""What keeps the work of large inputs bounded, on a few rows."""

from datetime import datetime

from pyspark.sql import functions as F

from plazalens import session
from plazalens.plans import stand_in
from plazalens.sinks import hours
from plazalens.sources.posts import good_posts, read_posts


def test_raw_files_are_deflated_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stand_in, "FILE_POSTS", 10)
    rows = [(k, k % 7, "P" if k % 3 else "F", datetime(2024, 1, 1), "1-URGENT") for k in range(45)] + [(None, None, None, None, None)]
    table = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string")
    table.write.parquet(str(tmp_path / "orders.parquet"))
    posts = stand_in.post_rows(spark, str(tmp_path))
    stand_in.write_raw(posts.coalesce(1), str(tmp_path / "raw"))
    files = sorted((tmp_path / "raw").glob("part-*"))
    assert len(files) == 5 and all(f.name.endswith(".json.deflate") for f in files)
    posts.write.json(str(tmp_path / "plain"))
    read = [sorted(map(str, good_posts(read_posts(spark, str(tmp_path / f))).collect())) for f in ("raw", "plain")]
    assert read[0] == read[1] and len(read[0]) == 46
    feed = spark.read.schema(read_posts(spark, str(tmp_path / "raw")).schema).json(str(tmp_path / "raw"))
    assert feed.where(F.col("id").isNotNull()).count() == 45


def _loaded(spark, root, names):
    store = hours.HourStore(spark, root)
    change = store.change()
    change.append(hours.SOURCES, spark.createDataFrame([(n, 1, "none") for n in names], "source string, posts long, period string"))
    change.commit()
    return store


def test_unread_does_not_deal_rows_by_name(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id long, source string")
    fresh = hours.HourStore(spark, str(tmp_path / "none"))
    assert hours.unread(fresh, rows, "source").count() == 4
    store = _loaded(spark, str(tmp_path / "some"), ["b", "b", "z"])
    left = [hours.unread(store, rows, "source")]
    monkeypatch.setattr(hours, "small_rows", lambda df: None)
    left.append(hours.unread(store, rows, "source"))
    for some in left:
        assert sorted(r.id for r in some.collect()) == [1, 4]
        assert "hashpartitioning(source" not in some._jdf.queryExecution().toString()


def test_loaded_files_are_not_scanned_again(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.range(10).repartition(2).write.json(raw)
    rows = spark.read.schema("id long").json(raw).select("*", F.col("_metadata.file_path").alias("source"))
    names = sorted(r[0] for r in rows.select("source").distinct().collect())
    store = _loaded(spark, str(tmp_path / "out"), names[:1])
    left = hours.unread(store, rows, "source")
    assert {r.source for r in left.collect()} == set(names[1:])
    assert "Join" not in left._jdf.queryExecution().optimizedPlan().toString()


def test_task_sizes_are_set_where_a_session_has_none(spark):
    own = spark.newSession()
    for key in session.TASK_SIZES:
        own.conf.unset(key)
    own.conf.set("spark.sql.files.maxPartitionBytes", "7m")
    session.bound_tasks(own)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "7m"
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
