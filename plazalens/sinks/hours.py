"""Tables by event time, changed by whole commits.

    <root>/<table>/version=<n>/period=<pNNNNNNNNNN>/part-*.parquet
    <root>/commits/version=<n>/part-*.parquet        table, period: what the version holds

A change writes new folders only and is there once its one commit file is. What a crashed change has left is never read, and the next
change, which takes the same number, writes over it. Of a *merged* table the newest version of a period is the period; of an *appended*
one all versions are. Periods that a change doesn't touch aren't rewritten. A period is an hour, or longer where hours hold little.

One writer at a time: a second one that takes the same number fails at its commit.
"""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from plazalens.operators.dims import small_rows

# Bits of a period's filter of seen ids. Only groups of bits with a bit set are stored, and those packed; a period of more ids than a tenth
# of the bits sends more of a batch through the exact test.
FILTER_BITS = 1 << 23
GROUP_BITS = 1 << 15  # of Spark's bitmap functions

IDS, FILTERS, SOURCES = "seen_ids", "seen_filters", "sources"
_COMMITS = StructType([StructField("table", StringType()), StructField("period", StringType()), StructField("version", IntegerType())])
ID_SCHEMA = StructType([StructField("id", StringType())])
FILTER_SCHEMA = StructType([StructField("bits_group", LongType()), StructField("bits", BinaryType())])
SOURCE_SCHEMA = StructType([StructField("source", StringType()), StructField("posts", LongType())])


# How much time a folder covers, and with it what a late post has rewritten
PERIODS = {"hour": "yyyyMMddHH", "day": "yyyyMMdd", "month": "yyyyMM", "year": "yyyy"}


def period_of(time: Column, unit: str = "hour") -> Column:
    """Folder name of an event time. It begins with a letter, so that nothing takes it for a number; rows without a time have one too."""
    return F.coalesce(F.concat(F.lit("p"), F.date_format(time, PERIODS[unit])), F.lit("none"))


class HourStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> DataFrame:
        """table, period, version of all commits."""
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)

    def last(self) -> int:
        found = self.commits().agg(F.max("version")).first()[0]
        return -1 if found is None else found

    def live(self, table: str, merged: bool) -> DataFrame:
        """period, version of the folders that make up a table."""
        held = self.commits().where(F.col("table") == table)
        return held.groupBy("period").agg(F.max("version").alias("version")) if merged else held.select("period", "version")

    def read(self, table: str, schema: StructType, merged: bool = True, periods: list[str] | None = None) -> DataFrame:
        """The table as of its last commit, ``schema`` and ``period``. ``periods``: only those; other folders are not read."""
        live = self.live(table, merged)
        extra = StructType([*schema.fields, StructField("version", IntegerType()), StructField("period", StringType())])
        try:
            rows = self.spark.read.schema(extra).parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], extra).select(*schema.names, "period")
        if periods is not None:
            rows, live = rows.where(F.col("period").isin(periods)), live.where(F.col("period").isin(periods))
        # folders of a table, not rows: the list has a line a period and version
        return rows.join(F.broadcast(live), ["period", "version"]).select(*schema.names, "period")

    def change(self) -> "Change":
        return Change(self, self.last() + 1)


class Change:
    """One version being written. Nothing of it shows before ``commit``."""

    def __init__(self, store: HourStore, version: int):
        self.store, self.spark, self.version = store, store.spark, version
        self.tables: list[str] = []

    def _folder(self, table: str) -> str:
        return f"{self.store.root}/{table}/version={self.version}"

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written beside the tables and read back; the next change writes over it."""
        folder = f"{self.store.root}/scratch/{name}"
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def append(self, table: str, rows: DataFrame) -> DataFrame:
        """Adds rows (with ``period``) to an appended table; returns them as written. Periods are spread or put together by size."""
        rows.hint("rebalance", F.col("period")).write.mode("overwrite").partitionBy("period").parquet(self._folder(table))
        self.tables.append(table)
        names = [c for c in rows.columns if c != "period"]
        fields = [rows.schema[c] for c in names] + [StructField("period", StringType())]
        return self.spark.read.schema(StructType(fields)).parquet(self._folder(table))

    def merge(self, table: str, rows: DataFrame, keys: list[str], periods: list[str], **measures: Column) -> None:
        """Adds ``rows`` (keys, measures, ``period``) to a merged table: their ``periods`` are written anew with what they held before,
        grouped by ``keys``; measures are summed unless told otherwise."""
        names = [c for c in rows.columns if c not in keys and c != "period"]
        schema = StructType([rows.schema[c] for c in rows.columns if c != "period"])
        before = self.store.read(table, schema, periods=periods)
        aggregates = [measures.get(c, F.sum(c)).alias(c) for c in names]
        whole = before.unionByName(rows.select(*schema.names, "period")).groupBy("period", *keys).agg(*aggregates)
        self.append(table, whole.select(*schema.names, "period"))

    def commit(self) -> None:
        """Makes the version count, in one file. Fails if another writer has taken the number."""
        held = [("", "")]  # a change without rows is a commit too
        for table in self.tables:
            files = self.spark.read.schema("period string").parquet(self._folder(table)).inputFiles()
            held += sorted({(table, m[1]) for m in (re.search("/period=([^/]+)/", f) for f in files) if m})
        rows = self.spark.createDataFrame(held, "table string, period string")
        rows.coalesce(1).write.mode("error").parquet(f"{self.store.root}/commits/version={self.version}")


def periods_of(rows: DataFrame) -> list[str]:
    """The periods of a batch: as many as it spans, not as many as it has rows."""
    return [r[0] for r in rows.select("period").distinct().collect()]


# ---------------------------------------------------------------- what was seen before


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def maybe_seen(store: HourStore, ids: DataFrame, periods: list[str]) -> DataFrame:
    """Of ``ids`` (period, id) those whose bit is set in their period's filter: all seen ones, and few others."""
    bit = F.col("_bit")
    placed = ids.withColumn("_bit", _bit(F.col("id"))).select(
        "period", "id", F.expr(f"_bit div {GROUP_BITS}").alias("bits_group"), (bit % GROUP_BITS).cast("int").alias("_at")
    )
    filters = store.read(FILTERS, FILTER_SCHEMA, periods=periods)
    byte = F.conv(F.hex(F.col("bits").substr(F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.get(F.array(*[byte.bitwiseAND(1 << j) for j in range(8)]), F.col("_at") % 8) != 0
    return placed.join(filters, ["period", "bits_group"]).where(is_set).select("period", "id")


def unseen(store: HourStore, posts: DataFrame, periods: list[str], batch: DataFrame | None = None) -> DataFrame:
    """Posts whose id no earlier commit holds for their period. ``posts`` has id and period and each id once; those without an id all stay.

    Only ids that pass the filter meet the index, and only in the folders of their periods. The ids are taken from ``batch``, written rows
    that ``posts`` was made of (repeats do no harm), so that ``posts`` need not be written to be read once; without it ``posts`` is read twice.
    """
    if store.last() < 0:
        return posts
    ids = (posts if batch is None else batch).where(F.col("id").isNotNull()).select("period", F.col("id").cast("string").alias("id"))
    maybe = maybe_seen(store, ids, periods)
    index = store.read(IDS, ID_SCHEMA, merged=False, periods=periods)
    seen = index.join(maybe, ["period", "id"], "left_semi").select(F.col("period").alias("_h"), F.col("id").alias("_i"))
    return posts.join(seen, (F.col("period") == F.col("_h")) & (F.col("id").cast("string") == F.col("_i")), "left_anti")


def remember(change: Change, posts: DataFrame, periods: list[str]) -> None:
    """Adds the ids of ``posts`` (id, period) to the index and to the filters of their periods."""
    ids = change.append(IDS, posts.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), "period"))
    bits = ids.withColumn("_bit", _bit(F.col("id"))).groupBy("period", F.expr(f"_bit div {GROUP_BITS}").alias("bits_group"))
    rows = bits.agg(F.bitmap_construct_agg(F.col("_bit") % GROUP_BITS).alias("bits"))
    change.merge(FILTERS, rows.select("bits_group", "bits", "period"), ["bits_group"], periods, bits=F.bitmap_or_agg("bits"))


def unread(store: HourStore, rows: DataFrame, source: str) -> DataFrame:
    """Rows of source files that no commit has loaded. ``rows`` best comes before any costly step: where ``source`` is a scan's file path,
    loaded files are not read again.

    Names, not rows, decide: up to LITERAL_ROWS loaded names become a literal set, more are joined. They never move the rows by name,
    which would put a file, or a batch known by one name, into one task.
    """
    if store.last() < 0:
        return rows
    named = rows.select(F.col(source).alias("_done")).distinct()
    done = store.read(SOURCES, SOURCE_SCHEMA, merged=False).select(F.col("source").alias("_done"))
    done = done.distinct().join(F.broadcast(named), "_done", "left_semi")
    loaded = small_rows(done)
    if loaded is None:
        return rows.join(F.broadcast(done), F.col(source) == F.col("_done"), "left_anti")
    names = [r[0] for r in loaded]
    return rows.where(F.col(source).isNull() | ~F.col(source).isin(names)) if names else rows
