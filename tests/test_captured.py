"""Tracked handles, the flat feed's clock, and repeated posts in a stream."""

from pyspark.sql import functions as F

from plazalens.operators import capture, dedup


def test_tracked_handles_end_at_an_edge(spark):
    texts = ["hi @Ana!", "@anabel", "x @ana", "@ana_1", "(@ANA)", None]
    posts = spark.createDataFrame([(t, "9") for t in texts], "text string, author_id string")
    kept = {r["text"] for r in capture.capture_filter_flat(posts, [], ["@Ana"]).collect()}
    assert kept == {"hi @Ana!", "x @ana", "(@ANA)"}


def test_flat_feed_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        posts = spark.createDataFrame([("1", "x", "9")], "id string, text string, author_id string")
        posts = posts.withColumn("created_at", F.lit("2024-01-02T02:00:00Z").cast("timestamp"))
        row = capture.flatten_flat(posts).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row["datetime"], row["date"]) == ("2024-01-02T02:00:00+00:00", "2024-01-02")


def test_stream_keeps_posts_without_id(spark, tmp_path):
    rows = [("1", 10), ("1", 10), (None, 10), (None, 10), ("2", 11)]
    posts = spark.createDataFrame(rows, "id string, n long").withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    posts.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(posts.schema).parquet(f"{tmp_path}/in")
    once = dedup.drop_repeated_within(stream)
    assert once.columns == posts.columns
    query = once.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start(f"{tmp_path}/out")
    query.awaitTermination()
    assert sorted(str(r["id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["1", "2", "None", "None"]


def test_rows_of_several_files_keep_their_order(spark, tmp_path):
    from plazalens.sources import dimensions

    folder = tmp_path / "words"
    folder.mkdir()
    words = [[f"w{i}_{j}" + ("\nline" if j % 5 == 0 else "") for j in range(n)] for i, n in enumerate((3, 400, 1, 0, 50))]
    for i, part in enumerate(words):
        (folder / f"part-{i}.csv").write_text("word\n" + "".join(f'"{w}"\n' for w in part))
    found = dimensions.read_keywords(spark, str(folder)).orderBy("ord").collect()
    assert [(r["word"], r["ord"]) for r in found] == list(zip([w for part in words for w in part], range(454)))
    assert dimensions.read_categories(spark, str(folder)).columns == ["Insulto", "Insulto_gendered", "Categoría", "Subcategoría"]
    # several blocks of one file
    ordered = spark.range(0, 20000, 1, 1).selectExpr("concat('w', id) word")
    ordered.write.option("parquet.block.size", 16384).parquet(str(tmp_path / "blocks"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = dimensions.read_keywords(spark, str(tmp_path / "blocks"), "parquet").orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["word"] for r in found] == [f"w{i}" for i in range(20000)] and found[-1]["ord"] == 19999
