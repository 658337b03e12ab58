"""The registered queries of the training-data operators, each over its whole table with production parameters."""

from pyspark.sql import functions as F

from plazalens.llm import collocations, decontam, language, merkle, mixing, neardup, perplexity, pii, secrets, sharding, suffixdedup, urls, warc
from plazalens.llm.common import count_words, table

# The domain rules of the URL query, and the labels whose pages make up the feed of listed URLs
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
LISTED_SITES = "(^|[.])(cheap-pills|casino-win|free-bets|ads-track)[.]"
# A production run takes its key from a secret store
PII_KEY = "pseudonyms-2024"
SHARDS = 8
CRAWL_DATE = "2024-06-01T00:00:00Z"


def op1_pii(spark, sf):
    found = pii.pseudonymised(table(spark, sf, "documents"), PII_KEY, "doc_id")
    return found.select("doc_id", "text", F.size("found").alias("n_replaced"), F.array_join("found", ",").alias("kinds"))


def op2_suffixdedup(spark, sf):
    found = suffixdedup.without_repeats(table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_mixing(spark, sf):
    docs = table(spark, sf, "documents")
    mixed = mixing.mix(docs, count_words(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"), "repeats")


def op4_neardup(spark, sf):
    return neardup.near_duplicates(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op5_decontam(spark, sf):
    found = decontam.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id")
    items = F.col("items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_perplexity(spark, sf):
    found = perplexity.quality(table(spark, sf, "documents"), "doc_id")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *base, "base_failed", "kept", "log_perplexity", "lower", "upper")


def op7_language(spark, sf):
    docs = table(spark, sf, "documents")
    found = language.identify(docs, language.fit(docs), "doc_id")
    return found.select("doc_id", (~language.is_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def op8_urls(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    feed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_SITES)).select("url")
    return urls.filter_urls(pages, URL_RULES, feed).select("page_id", "host", "path", "rule", "verdict", "is_listed")


def op9_secrets(spark, sf):
    found = secrets.find_secrets(table(spark, sf, "documents"), "doc_id")
    spans = F.col("spans")
    counts = [secrets.count_of(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, secrets.digest_of_base(spans).alias("base_sha256"), secrets.joined(spans).alias("spans"))


def op10_warc(spark, sf):
    return warc.derivatives(warc.responses_of_pages(table(spark, sf, "pages"), CRAWL_DATE), "page_id")


def op11_merkle(spark, sf):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(table(spark, sf, "documents"), tampered)


def op12_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


def op13_sharding(spark, sf):
    return sharding.shards(table(spark, sf, "documents"), SHARDS)


OPERATORS = (op1_pii, op2_suffixdedup, op3_mixing, op4_neardup, op5_decontam, op6_perplexity, op7_language, op8_urls, op9_secrets, op10_warc, op11_merkle, op12_collocations, op13_sharding)
QUERIES = {f.__name__: f for f in OPERATORS}
