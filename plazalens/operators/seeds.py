"""The seed accounts: membership tests, paging, handle changes."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.functions.handles import HandleGroups, handle_candidates, mark_tokens, replace_handles, swap_handles
from plazalens.functions.text import strip
from plazalens.operators.dims import LITERAL_ROWS, at_most, attach_lookup, small_rows
from plazalens.operators.pattern_index import PLAN_PATTERNS, attach_candidates, pattern_index

# The prefix of every id, and how many accounts one capture follows
ID_PREFIX = "id_"
PAGE = 400


def prefixed(c: Column) -> Column:
    return F.concat(F.lit(ID_PREFIX), c.cast("string"))


@dataclass
class SeedTests:
    """Boolean tests on a handle (any case) and on a prefixed account id."""

    is_female: Callable[[Column], Column]
    is_male: Callable[[Column], Column]
    is_seed_id: Callable[[Column], Column]


def _in(values) -> Callable[[Column], Column]:
    values = sorted(set(values))
    return lambda c: c.isin(values) if values else F.when(c.isNotNull(), F.lit(False))


def seed_tests(
    df: DataFrame, seeds: DataFrame, handles: Column, account: Column, literal_rows: int = LITERAL_ROWS
) -> tuple[DataFrame, SeedTests]:
    """Tests for the row's ``handles`` (array) and ``account`` (prefixed id), and the frame they work on.

    A short seed list becomes literal hash sets. A long one is joined once: one map per row, from each of its handles
    and its account to what the seed list says about them.
    """
    wanted = seeds.select("user_id", "screen_name", "Genero")
    rows = small_rows(wanted, literal_rows)
    if rows is not None:
        by_gender = {g: [r.screen_name.lower() for r in rows if r.Genero == g and r.screen_name] for g in "FM"}
        female, male = _in(by_gender["F"]), _in(by_gender["M"])
        ids = _in([ID_PREFIX + str(r.user_id) for r in rows if r.user_id is not None])
        return df, SeedTests(lambda h: female(F.lower(h)), lambda h: male(F.lower(h)), ids)

    said = F.expr("case Genero when 'F' then 1 when 'M' then 2 else 0 end")
    dim = (
        seeds.select(F.concat(F.lit("@"), F.lower("screen_name")).alias("_key"), said.alias("_said"))
        .unionAll(seeds.select(prefixed(F.col("user_id")), F.lit(4)))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.bit_or("_said").alias("_said"))
    )
    named = F.transform(handles, lambda h: F.concat(F.lit("@"), F.lower(h)))
    keys = F.concat(F.coalesce(named, F.array().cast("array<string>")), F.array(account))
    marked = attach_lookup(df, "id", keys, dim, "_key", "_said", "_seed_map")

    def has(bit: int, key: Column) -> Column:
        return F.when(
            key.isNotNull(), F.coalesce(F.try_element_at("_seed_map", key), F.lit(0)).bitwiseAND(bit) == bit
        )

    return marked, SeedTests(
        lambda h: has(1, F.concat(F.lit("@"), F.lower(h))),
        lambda h: has(2, F.concat(F.lit("@"), F.lower(h))),
        lambda i: has(4, i),
    )


def handle_groups(
    df: DataFrame, text: Column, seeds: DataFrame, row_key: str = "id", literal_rows: int = LITERAL_ROWS
) -> tuple[DataFrame, list[str], Callable[[Column], Column]]:
    """Group tokens in seed order, and the lookup lower-cased handle -> token, on the frame it works on.

    A handle listed under several tokens belongs to the token that appears first.
    """
    named, first_seen = _named_groups(seeds)
    tokens = small_rows(first_seen, literal_rows)
    if tokens is None:
        raise ValueError("more distinct tokens than a plan can name; with_group_tokens takes any number")
    order = [r.token for r in sorted(tokens, key=lambda r: (r.ord, r.token))]
    rows = small_rows(named.select("screen_name", "token"), literal_rows)
    if rows is not None:
        groups = {t: [r.screen_name for r in rows if r.token == t] for t in order}
        found = HandleGroups(groups)
        return df, order, found.token_of
    return _handles_joined(df, text, named, first_seen, row_key), order, _joined_token


def _named_groups(seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    named = seeds.where(F.col("screen_name").isNotNull() & F.col("token").isNotNull())
    return named, named.groupBy("token").agg(F.min("ord").alias("ord"))


def _handles_joined(df: DataFrame, text: Column, named: DataFrame, first_seen: DataFrame, row_key: str) -> DataFrame:
    ranked = named.select("screen_name", "token").join(first_seen, "token")
    first = F.min_by("token", F.struct("ord", "token")).alias("_token")
    dim = ranked.groupBy(F.lower("screen_name").alias("_handle")).agg(first)
    return attach_lookup(df, row_key, handle_candidates(text), dim, "_handle", "_token", "_token_map")


def _joined_token(handle: Column) -> Column:
    return F.try_element_at("_token_map", handle)


def _token_pattern(token: Column) -> Column:
    # putting an @ in front of one token can complete another one, so an @ inside a token may be missing yet
    quoted = F.regexp_replace(token, r"([^\w\s@])", r"\\$1")
    return F.replace(quoted, F.lit("@"), F.lit("@?"))


def with_group_tokens(
    df: DataFrame, text: str, seeds: DataFrame, out: str, row_key: str = "id", plan_tokens: int = PLAN_PATTERNS, literal_rows: int = LITERAL_ROWS
) -> DataFrame:
    """Adds ``out``: column ``text`` with handles replaced by their group's token, for any number of tokens.

    Up to ``plan_tokens`` tokens are steps of the plan. More are filed in an index, and each text is marked with the tokens it may hold.
    """
    named, first_seen = _named_groups(seeds)
    if at_most(first_seen, plan_tokens):
        marked, tokens, token_of = handle_groups(df, F.col(text), seeds, row_key, literal_rows)
        return marked.select(*df.columns, replace_handles(F.col(text), tokens, token_of).alias(out))
    swapped = _handles_joined(df, F.col(text), named, first_seen, row_key)
    swapped = swapped.select(*df.columns, swap_handles(F.col(text), _joined_token).alias(out))
    patterns = first_seen.select(F.lit("").alias("list"), "ord", _token_pattern(F.col("token")).alias("pattern"), F.col("token").alias("name"))
    held = attach_candidates(swapped, F.col(out), pattern_index(patterns), "_tokens")
    ranked = F.array_sort(F.transform("_tokens", lambda t: F.struct(t["ord"].alias("ord"), t["name"].alias("name"))))
    marks = F.transform(ranked, lambda t: t["name"])
    return held.withColumn(out, mark_tokens(F.col(out), marks)).drop("_tokens")


def as_tokens(seeds: DataFrame) -> DataFrame:
    return seeds.withColumnRenamed("Tipo", "token")


def influencers(seeds: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``mention -> influencer_id``, the handle stripped. With ``case_sensitive=False`` the mention is lower-cased."""
    handle = strip(F.col("Twitter"))
    mention = handle if case_sensitive else F.lower(handle)
    return seeds.select(mention.alias("mention"), prefixed(F.col("user_id")).alias("influencer_id"))


def seed_pages(seeds: DataFrame, column: str, page: int = PAGE, stride: int = 1_000_000) -> DataFrame:
    """``page_no`` of each non-null ``column`` value in ``ord`` order.

    A row's rank is the number of rows in earlier strides of ``ord`` plus its rank within its own stride, so no task
    sees the whole list; only one count per stride meets in one place.
    """
    kept = seeds.where(F.col(column).isNotNull()).select(column, "ord").withColumn("_stride", F.expr(f"ord div {stride}"))
    ahead = Window.orderBy("_stride").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        kept.groupBy("_stride")
        .agg(F.count("*").alias("_n"))
        .select("_stride", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    )
    rank = F.col("_start") + F.row_number().over(Window.partitionBy("_stride").orderBy("ord")) - 1
    return kept.join(starts, "_stride").select(column, "ord", F.floor(rank / page).cast("bigint").alias("page_no"))


def tracking_words(seeds: DataFrame, keywords: DataFrame) -> DataFrame:
    """What the capture listens to: ``@handle`` for every proper handle, then the keywords."""
    handles = seeds.where(F.col("screen_name").isNotNull() & ~F.contains("screen_name", F.lit("#")))
    return handles.select(F.concat(F.lit("@"), F.col("screen_name")).alias("word")).unionAll(keywords.select("word"))


def handle_of_account(seeds: DataFrame) -> DataFrame:
    """``user_id -> handle`` without ``@``; the last row of an account wins."""
    known = seeds.where(F.col("user_id").isNotNull())
    handle = F.replace(F.col("screen_name"), F.lit("@"), F.lit(""))
    return known.groupBy("user_id").agg(F.max_by(handle, F.col("ord")).alias("screen_name"))


def latest_handles(posts: DataFrame, user_id: str = "user_id", handle: str = "screen_name", at: str = "datetime") -> DataFrame:
    """The handle each account used last."""
    known = posts.where(F.col(user_id).isNotNull() & F.col(handle).isNotNull())
    newest = F.max_by(F.struct(F.col(handle).alias("h"), F.col(at).alias("t")), F.struct(F.col(at), F.col(handle)))
    return known.groupBy(F.col(user_id).alias("user_id")).agg(newest.alias("_new")).select(
        "user_id", F.col("_new.h").alias("new_handle"), F.col("_new.t").alias("seen_at")
    )


def apply_handle_changes(seeds: DataFrame, latest: DataFrame) -> DataFrame:
    """The seed list with changed handles written in: lower case, original spelling, and when it was seen.

    ``latest`` has one row per account and is narrowed to seed accounts by the join.
    """
    seen = F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss")
    changed = (F.lower("new_handle") != F.coalesce(F.col("screen_name"), F.lit(""))) & (
        # a post that arrives late does not undo a later change
        F.col("updated").isNull() | (seen > F.col("updated"))
    )
    joined = seeds.join(latest, "user_id", "left")
    new = {
        "screen_name": F.when(changed, F.lower("new_handle")).otherwise(F.col("screen_name")),
        "screen_name_orig": F.when(changed, F.col("new_handle")).otherwise(F.col("screen_name_orig")),
        "updated": F.when(changed, seen).otherwise(F.col("updated")),
    }
    return joined.select(*[(new[c] if c in new else F.col(c)).alias(c) for c in seeds.columns])
