"""Dictionary insults of abusive posts, after the dictionary's exclusions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.find import remove_hits
from plazalens.functions.text import computed_once
from plazalens.operators.dictionary import Dictionary, IndexedDictionary
from plazalens.operators.pattern_index import CandidateSearch, PlanSearch


def _search(
    posts: DataFrame, text: Column, dictionary: Dictionary | IndexedDictionary, search: PlanSearch | CandidateSearch, mode: str
) -> DataFrame:
    """Adds what is found in ``text``, whether the post is kept, and the insults' names.

    Excluded expressions are taken out of the text, then the male patterns: those are searched in the whole text but
    cut from what the first removal left.
    """
    cut = (
        posts.withColumn("_expressions", search.fuzzy("expressions", text))
        .withColumn("not_f", search.all("exclusions", text, mode))
        .withColumn("_cut", F.lower(remove_hits(F.lower(text), F.col("_expressions"))))
        .withColumn("text_filtered", remove_hits(F.col("_cut"), F.col("not_f")))
    )
    # the cut text may match other patterns than the whole one
    cut, search = dictionary.on(cut, F.col("text_filtered"))
    found = (
        cut.withColumn("female_insults", search.all("insults_female", F.col("text_filtered"), mode))
        .withColumn("fiu_insults", search.all("insults_fiu", F.col("text_filtered"), mode))
        .withColumn("_names", search.names(F.col("fiu_insults")))
    )
    female_only = (F.size("fiu_insults") > 0) & (F.size("m_seed") == 0)
    kept = F.coalesce((F.size("female_insults") > 0) | female_only, F.lit(False))
    return found.withColumn("_kept", computed_once(kept)).drop("_expressions", "_cut", "_candidates")


def _with_hit(posts: DataFrame, hit: Column) -> DataFrame:
    marked = posts.withColumn("insults_search", hit)
    return marked.withColumn("_hit", computed_once(F.col("insults_search") != "")).where("_hit").drop("_hit")


def extract_insults(posts: DataFrame, dictionary: Dictionary | IndexedDictionary, mode: str = "auto") -> DataFrame:
    """Posts with at least one insult, and what was found.

    ``posts`` has ``text_clean``, ``abuse`` and ``m_seed``. The union of all patterns and the abuse flag filter first,
    so only that share of the posts meets the costlier steps.
    """
    text = F.col("text_clean")
    abusive, search = dictionary.on(posts.where(F.col("abuse") == 1), text)
    hit = _with_hit(abusive, search.first("insults_all", text))
    return _search(hit, text, dictionary, search, mode).where("_kept").drop("_kept").withColumnRenamed("_names", "insults_name")


def with_insult_names(posts: DataFrame, dictionary: Dictionary | IndexedDictionary, mode: str = "auto") -> DataFrame:
    """Every post, with ``insults_name`` where :func:`extract_insults` would keep it and null elsewhere.

    Saves the join that would bring the names back to all posts.
    """
    marked, search = dictionary.on(posts, F.when(F.col("abuse") == 1, F.col("text_clean")))
    marked = marked.withColumn("insults_search", search.first("insults_all", F.col("text_clean"))).withColumn(
        "_searched", F.when((F.col("abuse") == 1) & (F.col("insults_search") != ""), F.col("text_clean"))
    )
    found = _search(marked, F.col("_searched"), dictionary, search, mode)
    return found.select(*posts.columns, F.when(F.col("_kept"), F.col("_names")).alias("insults_name"))


def extract_male_insults(posts: DataFrame, dictionary: Dictionary | IndexedDictionary, mode: str = "auto") -> DataFrame:
    """The mirror rule for male insults: any post with a male pattern left once the excluded expressions are out."""
    text = F.col("text_clean")
    marked, search = dictionary.on(posts, text)
    cut = (
        _with_hit(marked, search.first("insults_male", text))
        .withColumn("not_m", search.all("expressions", text, mode))
        .withColumn("text_filtered", remove_hits(F.lower("text_clean"), F.col("not_m")))
    )
    cut, search = dictionary.on(cut, F.col("text_filtered"))
    return (
        cut.withColumn("male_insults", search.all("insults_male", F.col("text_filtered"), mode))
        .withColumn("_kept", computed_once(F.size("male_insults") > 0))
        .where("_kept")
        .drop("_kept", "_candidates")
    )
