"""Schemas of every input and output table."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_TEXT, _INT, _LONG, _FLAG, _TIME = StringType(), IntegerType(), LongType(), BooleanType(), TimestampNTZType()
_TEXTS = ArrayType(_TEXT)


def _struct(*texts: str, **others: DataType) -> StructType:
    """Text fields, then the others."""
    fields = [(t, _TEXT) for t in texts] + list(others.items())
    return StructType([StructField(name, kind) for name, kind in fields])


# Field names and nesting of the feed. Ids are read as strings, so that no 64-bit id loses digits.
_USER = _struct("id", "screen_name")
_ENTITIES = _struct(user_mentions=ArrayType(_struct("screen_name")))
_EXTENDED = _struct("full_text", entities=_ENTITIES)
_REPLY = ("in_reply_to_user_id", "in_reply_to_screen_name", "in_reply_to_status_id")
_QUOTED = _struct("text", "full_text", user=_USER, extended_tweet=_struct("full_text"))
_RETWEETED = _struct(
    "id", "text", "full_text", *_REPLY,
    user=_USER, extended_tweet=_EXTENDED, entities=_ENTITIES, quoted_status=_QUOTED,
)
CORRUPT = "_corrupt"

POST = _struct(
    "id", "id_str", "date", "datetime", "created_at", "lang", "text", "full_text", *_REPLY, "place", CORRUPT,
    id_num=_LONG, extended_tweet=_EXTENDED, entities=_ENTITIES, user=_USER, quoted_status=_QUOTED,
    retweeted_status=_RETWEETED,
)
# The feed's second, flat form
FLAT_POST = _struct("text", "created_at", "date", "datetime", CORRUPT, id=_LONG, author_id=_LONG)

# Dimensions. ``ord`` is the row order of the source file, which decides pages and first matches.
SEEDS = _struct(
    "user_id", "screen_name", "screen_name_orig", "updated", "Genero", "Tipo", "Twitter", "Nombre",
    followers_count=_INT, friends_count=_INT, ord=_LONG,
)
KEYWORDS = _struct("word", ord=_LONG)
INSULTS = _struct("regex3", "target", "gender", "orig_name", ord=_LONG)
CATEGORIES = _struct("Insulto", "Insulto_gendered", "Categoría", "Subcategoría")

# Outputs
TIDY = _struct(
    "id", "screen_name", "user_id", "text", "text_clean", "rt_from_screen_name", "rt_from_user_id", "rt_from_id",
    "qt_from_screen_name", "qt_status", "in_reply_to_screen_name", "in_reply_to_user_id", "in_reply_to_status_id",
    mentions=_TEXTS, f_seed=_TEXTS, m_seed=_TEXTS, directed_at_f=_INT, directed_at_m=_INT, hashtags=_TEXTS,
    datetime=_TIME, location=_TEXT, tweet_type=_TEXT, keywords=_TEXTS, valid=_FLAG,
)
# What the detection stage adds to a tidy post
FOUND = _struct(
    replaced_text=_TEXT, abuse=_INT, insults_search=_TEXT, not_f=_TEXTS, text_filtered=_TEXT, female_insults=_TEXTS,
    fiu_insults=_TEXTS, insults_name=_TEXTS,
)


def _counts(*keys: str, counts: str) -> StructType:
    return _struct(Hour=_TIME, **dict.fromkeys(keys, _TEXT), **dict.fromkeys(counts.split(), _LONG))


SUMMARIES = {
    "raw_data": _struct("id", "text", datetime=_TIME, user_id=_TEXT, keywords=_TEXTS, valid=_FLAG),
    "mentions_and_abuse_summary": _counts(
        "influencer_id", counts="N_mentions N_abuse N_mentions_orig N_mentions_rt N_abuse_orig N_abuse_rt"
    ),
    "insults_summary": _counts("influencer_id", "Insults", counts="N_abuse"),
    "hashtags_summary": _counts("influencer_id", "Hashtag", counts="N_hashtags"),
    "users_abuse_summary": _counts(
        "user_id",
        counts="N_user N_user_abuse N_user_original N_user_rt N_user_abuse_original N_user_abuse_rt",
    ),
    "subc_summary": _counts("influencer_id", "Subcategoría", counts="N_abuse"),
}
DIMENSION_TABLES = {
    "metadata": _struct("screen_name", "Nombre", "Tipo", followers_count=_INT, friends_count=_INT, user_id=_TEXT),
    "insult_to_group": _struct("Insulto", "Insulto_gendered", "Categoria", "Subcategoria"),
}
# Column types for a relational target (``createTableColumnTypes``)
JDBC_TYPES = {
    "metadata": "screen_name VARCHAR(100), Nombre VARCHAR(500), Tipo VARCHAR(100), user_id VARCHAR(100)",
    "insult_to_group": "Insulto VARCHAR(200), Insulto_gendered VARCHAR(200), Categoria VARCHAR(200), Subcategoria VARCHAR(300)",
    "raw_data": "id VARCHAR(500), text VARCHAR(2500), user_id VARCHAR(200), keywords VARCHAR(500), valid VARCHAR(10)",
    "mentions_and_abuse_summary": "influencer_id VARCHAR(500)",
    "insults_summary": "influencer_id VARCHAR(500), Insults VARCHAR(500)",
    "hashtags_summary": "influencer_id VARCHAR(500), Hashtag VARCHAR(500)",
    "users_abuse_summary": "user_id VARCHAR(500)",
    "subc_summary": "influencer_id VARCHAR(500), `Subcategoría` VARCHAR(500)",
}
FAILURES = _struct("source", "error_msg", "exception", at=TimestampType())
