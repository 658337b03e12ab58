"""The insult dictionary: subsets, pattern lists, ordered map; and the category dictionary's filter."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.operators.dims import at_most
from plazalens.operators.pattern_index import PLAN_PATTERNS, CandidateSearch, PatternIndex, PlanSearch, attach_candidates, pattern_index

# Target codes
EXCLUDED = "Exclude"
NAMED_TARGETS = ("FS", "FP", "US", "IS", "IP", "MP")
MALE_TARGETS = ("MS", "MP")
FEMALE, MALE = "F", "M"
# Fixed value: the category that is not loaded
NOT_AN_INSULT = "Criticas al ejercicio de su profesión"


def subsets() -> dict[str, Column]:
    """The pattern lists as predicates over the dictionary. A null target or gender is in no list but the first."""
    target, gender = F.col("target"), F.col("gender")
    return {
        "insults_all": F.coalesce(target != EXCLUDED, F.lit(True)),
        "insults_fiu": target.isin(*NAMED_TARGETS),
        "insults_female": gender == FEMALE,
        "insults_male": gender == MALE,
        "expressions": target == EXCLUDED,
        "exclusions": target.isin(*MALE_TARGETS),
    }


def pattern_lists(insults: DataFrame) -> DataFrame:
    """One row; each column joins the patterns of one subset with ``|`` in ``ord`` order."""

    def joined(keep: Column) -> Column:
        rows = F.array_sort(F.collect_list(F.when(keep, F.struct("ord", "regex3"))))
        return F.array_join(rows["regex3"], "|")

    return insults.agg(*[joined(keep).alias(name) for name, keep in subsets().items()])


def pattern_map(insults: DataFrame) -> DataFrame:
    """``regex3 -> name, target`` for the named targets; a repeated pattern keeps its first place, its last entry."""
    named = insults.where(F.col("target").isin(*NAMED_TARGETS))
    return named.groupBy("regex3").agg(
        F.min("ord").alias("ord"),
        F.max_by("orig_name", "ord").alias("name"),
        F.max_by("target", "ord").alias("target"),
    )


@dataclass
class Dictionary:
    """Pattern lists and name entries as plain values, ready to be written into expressions."""

    insults_all: str
    insults_fiu: str
    insults_female: str
    insults_male: str
    expressions: str
    exclusions: str
    entries: list[tuple[str, str]]

    def on(self, posts: DataFrame, text: Column) -> tuple[DataFrame, PlanSearch]:
        """The posts, and the search to run on ``text``."""
        return posts, PlanSearch({name: getattr(self, name) for name in subsets()}, self.entries)


@dataclass
class IndexedDictionary:
    """The same for a dictionary of any length: each text is searched with those patterns that it may match."""

    index: PatternIndex
    column: str = "_candidates"

    def on(self, posts: DataFrame, text: Column) -> tuple[DataFrame, CandidateSearch]:
        """The posts with the candidates of the lower-cased ``text`` (column ``_candidates``, replaced if it is there), and the search."""
        return attach_candidates(posts.drop(self.column), F.lower(text), self.index, self.column), CandidateSearch(self.column, self.index.in_scan)


def index_dictionary(insults: DataFrame) -> IndexedDictionary:
    """Each list's patterns stand on their own here: a numbered back reference counts the groups of its own pattern only."""
    rows = insults.where(F.col("regex3").isNotNull())
    named = pattern_map(rows).select(F.lit("entries").alias("list"), "ord", F.col("regex3").alias("pattern"), "name")
    lists = F.array_compact(F.array(*[F.when(keep, F.lit(name)) for name, keep in subsets().items()]))
    listed = rows.select(F.explode(lists).alias("list"), "ord", F.col("regex3").alias("pattern"), F.lit(None).cast("string").alias("name"))
    return IndexedDictionary(pattern_index(listed.unionByName(named)))


def compile_dictionary(insults: DataFrame, plan_patterns: int = PLAN_PATTERNS) -> Dictionary | IndexedDictionary:
    """Up to ``plan_patterns`` patterns are written into the plan, more are indexed; what is found is the same."""
    kept = insults.select("ord", "regex3", "target", "gender", "orig_name").where(F.col("regex3").isNotNull())
    if not at_most(kept, plan_patterns):
        return index_dictionary(kept)
    lists = pattern_lists(kept).first()
    entries = [(r.regex3, r.name) for r in pattern_map(kept).orderBy("ord").collect()]
    return Dictionary(**lists.asDict(), entries=entries)


def without_category(categories: DataFrame, column: str = "Categoría", dropped: tuple = (NOT_AN_INSULT,)) -> DataFrame:
    """Rows outside the dropped categories; rows without a category stay, which a bare NOT IN would lose."""
    return categories.where(~F.coalesce(F.col(column).isin(*dropped), F.lit(False)))
