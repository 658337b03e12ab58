"""The model's tables, derived from the TPC-H-like test tables.

Every view here is a plain projection or join over whole tables, so work on it grows with them. The SQL texts are read
by Spark and by the check engine alike; ``{orders}`` and the like stand for the tables.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.operators.dims import at_most, never_broadcast
from plazalens.schemas import SEEDS
from plazalens.session import shared_dir
from plazalens.sources.posts import read_posts

VIEWS = {
    "tw": """select o_orderkey id, o_custkey user_id,
               o_orderdate + (o_orderkey % 24) * interval '1' hour + interval '7' minute ts,
               case when o_orderstatus = 'P' then o_custkey + 1 end rt
             from {orders} where o_orderkey in (select l_orderkey from {lineitem})""",
    "men": """select distinct l_orderkey id, l_suppkey mention
              from {lineitem} join {supplier} on s_suppkey = l_suppkey where s_nationkey % 2 = 0""",
    "seed": """select s_suppkey mention, case when s_suppkey % 7 <> 0 then s_suppkey + 1000 end influencer_id
               from {supplier}""",
    "hsh": "select l_orderkey id, p_brand hashtag from {lineitem} join {part} on p_partkey = l_partkey",
    "ab": """select l_orderkey id, max(case when l_returnflag = 'R' then 1 else 0 end) abuse
             from {lineitem} group by l_orderkey""",
    "ins": """select l_orderkey id, p_type insult from {lineitem} join {part} on p_partkey = l_partkey
              where l_returnflag = 'R' and l_quantity > 25""",
    "cat": """select distinct p_type as `Insulto`, concat(p_type, '-g') as `Insulto_gendered`,
                case p_type when 'PROMO' then null when 'LARGE' then 'size' when 'SMALL' then 'size'
                            when 'MEDIUM' then 'Criticas al ejercicio de su profesión' else 'kind' end as `Categoría`,
                case when p_type <> 'ECONOMY' then concat('sub', length(p_type)) end as `Subcategoría`
              from {part}""",
    "txt": """select doc_id id, concat('@Seed', doc_id % 40, '  ', text, ' #', source, ' #', lang,
                ' https://t.example/', doc_id, ' &amp; x') text from {documents}""",
    # a dictionary: one pattern per part type and size class, in order of first part
    "dict": """select lower(p_type) || (p_size % 3) regex3, min(p_partkey) ord,
                 case (min(p_partkey) + min(p_size)) % 6 when 0 then 'FS' when 1 then 'MP' when 2 then 'US' when 3 then 'MS'
                   when 4 then 'IP' else 'Exclude' end target,
                 case when min(p_size) % 2 = 0 then 'F' else 'M' end gender, min(p_name) orig_name
               from {part} group by lower(p_type) || (p_size % 3)""",
}

# Parameters of the post stand-in
GROUPS = ("mayor", "deputy", "press")
FILE_POSTS = 50_000
# Parts that a view's join may broadcast: a key and a short text each, some 50 MB
HELD_PARTS = 500_000


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a scan with fewer splits than cores (one small or unsplittable file) over all cores.

    Larger scans already have that many splits and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    tables = [t for t in ("orders", "lineitem", "supplier", "part", "documents") if "{" + t + "}" in text]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    if name == "txt":
        frames["documents"] = spread(frames["documents"], "doc_id")
    if "join {part}" in text and not at_most(frames["part"], HELD_PARTS):
        frames["part"] = never_broadcast(frames["part"])
    return spark.sql(text, **frames)


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as seed accounts: even nations female, every 29th with a null id, every 31st with a foreign handle."""
    (supplier,) = load(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    handle = F.concat(F.lit("seed"), key)
    made = {
        "user_id": F.when(key % 29 != 0, (key + 1000).cast("string")),
        "screen_name": F.when(key % 31 == 5, F.concat(F.lit("#"), handle)).otherwise(handle),
        "screen_name_orig": handle,
        "updated": F.lit(None),
        "Genero": F.when(F.col("s_nationkey") % 2 == 0, "F").otherwise("M"),
        "Tipo": F.element_at(F.array(*map(F.lit, GROUPS)), (key % 3 + 1).cast("int")),
        # the id table spells every other handle with a capital and pads it
        "Twitter": F.concat(F.lit(" Seed"), key, F.lit(" ")),
        "Nombre": F.col("s_name"),
        "followers_count": F.floor("s_acctbal"),
        "friends_count": key % 100,
        "ord": key,
    }
    return supplier.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in SEEDS.fields])


def _user(id_: F.Column, handle: F.Column) -> F.Column:
    return F.struct(id_.alias("id"), handle.alias("screen_name"))


def _entities(*handles: F.Column) -> F.Column:
    named = F.filter(F.array(*handles), lambda h: h.isNotNull())
    return F.struct(F.transform(named, lambda h: F.struct(h.alias("screen_name"))).alias("user_mentions"))


def post_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested post per order, field by field as the feed has them; the check texts state the same rules as a table."""
    orders = spread(load(spark, sf_dir, "orders")[0], "o_orderkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    author = F.concat(F.lit("User"), c)
    first = F.concat(F.lit("Seed"), k % 90)
    second = F.concat(F.lit("SEED"), (k * 7 + 3) % 120)
    itself = F.when(k % 4 == 0, author)
    again = F.when(k % 6 == 0, first)
    entities = _entities(first, second, itself, again)
    own = F.concat(
        F.lit("Él dijo "), F.col("o_orderpriority"), F.lit("\n¡NO!! @"), first, F.lit(" y @"), second,
        F.lit(" #"), F.col("o_orderstatus"), F.lit(" #Ñandú, sooo "), k, F.lit(" &amp; http://t.example/"), k,
        F.lit(" colección"), F.when(k % 11 == 0, " tontín").otherwise(""), F.when(k % 13 == 0, " bobo bobo").otherwise(""),
    )
    extended = F.when(
        k % 3 == 0, F.struct(F.concat(own, F.lit(" (más)")).alias("full_text"), entities.alias("entities"))
    )
    rt_own = F.concat(F.lit("RT uno\ndos @Seed"), (k + 1) % 90, F.lit(" #viva tontón "), F.col("o_orderpriority"))
    reply_id = F.when(k % 5 == 0, k % 150 + 1000)
    rt_reply_id = F.when(k % 7 == 0, k % 140 + 1000)
    quoted = F.when(
        k % 9 == 0,
        F.struct(
            _user(k % 50 + 5000, F.concat(F.lit("Quoted"), k % 50)).alias("user"),
            F.when(k % 2 == 0, F.lit("short quote")).alias("text"),
            F.when(k % 2 == 1, F.lit("full quote")).alias("full_text"),
            F.when(k % 36 == 0, F.struct(F.concat(F.lit("long quote "), k).alias("full_text"))).alias("extended_tweet"),
        ),
    )
    rt_quoted = F.when(
        k % 8 == 0, F.struct(_user(k % 40 + 6000, F.lit("Inner")).alias("user"), F.lit("inner quote").alias("text"))
    )
    retweeted = F.when(
        F.col("o_orderstatus") == "P",
        F.struct(
            (k + 900000000).alias("id"),
            _user(c + 1, F.concat(F.lit("User"), c + 1)).alias("user"),
            F.when(k % 2 == 0, rt_own).alias("text"),
            F.when(k % 2 == 1, rt_own).alias("full_text"),
            F.when(
                k % 10 == 0,
                F.struct(
                    F.concat(rt_own, F.lit(" y más")).alias("full_text"),
                    _entities(F.concat(F.lit("Seed"), (k + 2) % 90)).alias("entities"),
                ),
            ).alias("extended_tweet"),
            _entities(F.concat(F.lit("Seed"), (k + 1) % 90), itself).alias("entities"),
            rt_reply_id.alias("in_reply_to_user_id"),
            F.when(rt_reply_id.isNotNull(), F.lit("Replied")).alias("in_reply_to_screen_name"),
            F.when(rt_reply_id.isNotNull(), k + 1).alias("in_reply_to_status_id"),
            rt_quoted.alias("quoted_status"),
        ),
    )
    ts = F.expr("o_orderdate + (o_orderkey % 24) * interval '1' hour + interval '7' minute")
    return orders.select(
        k.alias("id"),
        k.cast("string").alias("id_str"),
        F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.lit("es").alias("lang"),
        F.when(k % 2 == 0, own).alias("text"),
        F.when(k % 2 == 1, own).alias("full_text"),
        extended.alias("extended_tweet"),
        entities.alias("entities"),
        _user(c, author).alias("user"),
        reply_id.alias("in_reply_to_user_id"),
        F.when(reply_id.isNotNull(), F.concat(F.lit("seed"), k % 150)).alias("in_reply_to_screen_name"),
        F.when(reply_id.isNotNull(), k - 1).alias("in_reply_to_status_id"),
        F.when(k % 20 == 0, F.struct(F.lit("UY").alias("country"))).alias("place"),
        quoted.alias("quoted_status"),
        retweeted.alias("retweeted_status"),
    )


def post_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as a feed of JSON text."""
    rows = post_rows(spark, sf_dir)
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("line"), F.col("id").alias("key"))


def write_raw(posts: DataFrame, folder: str) -> None:
    """Adds raw JSON-lines files to a folder. Feed text shrinks to a fraction when deflated; such a file is read by one task, so it holds
    a bounded number of posts. (The name of a gzip file would count as archived.)"""
    posts.write.mode("append").option("compression", "deflate").option("maxRecordsPerFile", FILE_POSTS).json(folder)


_written: dict[tuple[str, str], str] = {}


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """The posts as raw JSON-lines files in the shared folder, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        folder = f"{shared_dir(spark)}/raw-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
        write_raw(post_rows(spark, sf_dir), folder)
        _written[key] = folder
    return _written[key]


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, as the hourly run does between its stages. Texts are packed well, as they are
    written once and lie there as long as the query runs."""
    folder = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_posts(spark, raw_folder(spark, sf_dir))
