"""MinHash near-duplicates, verified by odd sketches and then on full shingle sets.

Texts with the same words are one class, found by hash before anything else. Classes meet in the buckets of banded MinHash values. A
bucket links its members to one of them, not to each other; what those links leave apart is compared further, but only across
components. An odd sketch of the MinHash values tells which candidates are worth an exact comparison.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.arrow import PLACE_CODES, chunks, grams, mixed, powers, text_column
from plazalens.llm.common import need, parked
from plazalens.llm.graph import components
from plazalens.llm.urls import passing

SHINGLE = 5
PERCENT = 75  # of the union that the intersection has at least
HASHES, BANDS = 128, 32
BITS = 512  # of an odd sketch
FULL_BITS = 1024  # of the parity bitmap of a whole shingle set
# Two sets of similarity 0.75 differ in more bits once in millions of pairs (mean 57, deviation 9)
MAX_DIFFERENT = 105
_rng = np.random.Generator(np.random.PCG64(7))
FACTORS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
SHIFTS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
PARTS = 4096  # shingles hashed at once


def shingle_sets(words: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; of a row of fewer words, the one of all its words."""
    hashes, begins = grams(words, bounds, SHINGLE)
    for i in range(len(bounds) - 1):
        if begins[i] < begins[i + 1]:
            yield np.unique(hashes[begins[i] : begins[i + 1]])
        else:
            own = words[bounds[i] : bounds[i + 1]]
            yield mixed(np.array([(own * PLACE_CODES[: len(own)]).sum() + np.uint64(len(own))])) if len(own) else own


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), PARTS):
        np.minimum(out, (x[None, at : at + PARTS] * FACTORS[:, None] + SHIFTS[:, None]).min(axis=1), out=out)
    return out


def bands_of(minima: np.ndarray) -> np.ndarray:
    rows = HASHES // BANDS
    parts = minima.reshape(*minima.shape[:-1], BANDS, rows).astype(np.uint64)
    return mixed((parts * PLACE_CODES[:rows]).sum(axis=-1) + PLACE_CODES[rows : rows + BANDS])


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each (place, value) of the MinHash flips one bit. Rows of BITS / 8 bytes."""
    n = len(minima)
    bit = mixed(minima.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))[None, :]) % np.uint64(BITS)
    cells = (np.arange(n)[:, None] * BITS + bit.astype(np.int64)).ravel()
    return np.packbits((np.bincount(cells, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS), axis=1)


def estimate(different: int) -> float:
    """Similarity that an odd sketch's number of different bits stands for."""
    return 1 + BITS / (4 * HASHES) * math.log(max(1e-9, 1 - 2 * different / BITS))


def class_keys(words: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits that tell sequences of words apart: two sums of word hashes by place."""
    counts = np.diff(bounds)
    place = np.arange(len(words)) - np.repeat(bounds[:-1], counts)
    weight = powers(int(counts.max(initial=1)))
    full = np.zeros((len(counts), 2), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        for j, value in enumerate((words, mixed(words ^ PLACE_CODES[0]))):
            full[some, j] = np.add.reduceat(value * weight[place], bounds[:-1][some])
    full[:, 0] += counts.astype(np.uint64)
    raw = mixed(full).astype(">u8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def _fixed(values: list[np.ndarray], width: int, kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(values) if values else np.zeros(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) // width + 1, dtype=np.int32) * width), pa.array(flat, kind))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, classes, minima = [], [], []
        for chunk in chunks(text_column(batch, "t")):
            words, bounds = chunk.words(lower=True)
            classes += class_keys(words, bounds)
            for shingles in shingle_sets(words, bounds):
                sizes.append(len(shingles))
                minima.append(min_hashes(shingles))
        table = np.array(minima, np.uint32).reshape(-1, HASHES)
        columns = [
            batch.column("id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
            _fixed([bands_of(table).view(np.int64).ravel()], BANDS, pa.int64()),
            _fixed([odd_sketches(table).view(">i8").astype(np.int64).ravel()], BITS // 64, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "class", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(text_column(batch, "t")):
            words, bounds = chunk.words(lower=True)
            sets = list(shingle_sets(words, bounds))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            cells = np.repeat(np.arange(len(sets)) * FULL_BITS, np.diff(ends)) + (flat & (FULL_BITS - 1))
            parity = (np.bincount(cells, minlength=len(sets) * FULL_BITS) & 1).astype(np.uint8).reshape(-1, FULL_BITS)
            parities = _fixed([np.packbits(parity, axis=1).view(np.int64).ravel()], FULL_BITS // 64, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(class_keys(words, bounds), pa.binary()), lists, parities], names=["class", "shingles", "parity"])


def _different(a: str, b: str, bits: int = BITS) -> Column:
    return sum((F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(bits // 64)), F.lit(0))


class _Verifier:
    """Exact comparison of class pairs. Shingle sets are computed again from the texts of the classes that are asked for."""

    def __init__(self, texts: DataFrame, reps: DataFrame):
        self.texts, self.reps = texts, reps

    def sets_of(self, classes: DataFrame) -> DataFrame:
        """class, shingles of distinct ``classes``: one text of each is read, and the few others that the filter lets through."""
        wanted = parked(self.reps.join(classes, "class", "left_semi").select("class", F.xxhash64("id").alias("key")), "wanted")
        texts = passing(self.texts.withColumn("key", F.xxhash64("id")), "key", wanted).select("t")
        sets = texts.mapInArrow(_sets, "class binary, shingles array<long>, parity array<long>")
        return parked(sets.join(wanted, "class", "left_semi").groupBy("class").agg(F.first("shingles").alias("shingles"), F.first("parity").alias("parity")), "sets")

    def plausible(self, pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            own = self.reps.select(F.col("class").alias(side), F.col("sketch").alias(f"s{side}"), F.col("n").alias(f"n{side}"))
            pairs = pairs.join(own, side)
        return parked(pairs.where(_plausible("na", "nb", "sa", "sb")).select("a", "b", "na", "nb"), "plausible")

    def linked(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """Those of ``pairs`` (a, b, na, nb) that are linked."""
        if sets is None:
            classes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
            sets = self.sets_of(classes)
        left = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a")
        both = left.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y")).cast("long")
        linked = both.withColumn("common", common).where(100 * F.col("common") >= PERCENT * (F.col("na") + F.col("nb") - F.col("common")))
        return parked(linked.select("a", "b"), "links")


def _plausible(na: str, nb: str, sa: str, sb: str) -> Column:
    """Sizes allow the similarity, and the sketches do."""
    sizes = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    return sizes & (_different(sa, sb) <= MAX_DIFFERENT)


def _split(members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component; ``major`` is a bucket's largest one."""
    placed = members.join(labels, members["class"] == labels["node"], "left")
    placed = placed.select("bucket", "class", F.coalesce("component", "class").alias("component"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    major = sizes.groupBy("bucket").agg(F.max_by("component", "size").alias("major"), F.count("*").alias("parts")).where("parts > 1")
    return parked(placed.join(major.select("bucket", "major"), "bucket").join(reps.select("class", "n"), "class"), "split")


# Sizes of one level differ by this factor at most
LEVEL = 1.1


def _alone(sets: DataFrame) -> DataFrame:
    """key (hash of the class), alone: how many shingles of a class no other class of ``sets`` has. No intersection holds them."""
    shingles = sets.select(F.xxhash64("class").alias("key"), F.explode("shingles").alias("shingle"))
    once = shingles.groupBy("shingle").agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n = 1")
    return once.groupBy("key").agg(F.count("*").alias("alone"))


def _level(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(LEVEL))).cast("int")


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of the pairs of a bucket, to be joined on bucket and level: members outside its largest component, once for each
    level of size that a linked set can have, and all members. ``rows``: bucket, major, class, component, n, shared, parity.

    A linked pair has PERCENT of each set in common, and of both sizes together the part that ``_across`` tests; what a member shares
    with no other class isn't in common. So a member that shares too little, with any set or with the sets of a level, is left out before
    anything meets: documents with one passage in common fill a bucket without meeting in it.
    """

    def side(x, *more):
        return rows.select("bucket", *more, *[F.col(c).alias(f"{c}_{x}") for c in ("class", "component", "n", "parity", "shared")])

    enough = f"100 * shared_{{x}} >= {PERCENT} * n_{{x}}"
    minor = side("a", "major").where("component_a <> major").drop("major").where(enough.format(x="a"))
    first, last = _level(F.ceil(F.col("n_a") * PERCENT / 100)), _level(F.floor(F.col("n_a") * 100 / PERCENT))
    # a level's sizes begin here or above; one less, so that rounding can't lose a pair
    least = F.greatest(F.pow(F.lit(LEVEL), F.col("level")) - 1, F.lit(1.0))
    minor = minor.withColumn("level", F.explode(F.sequence(first, last)))
    minor = minor.where((100 + PERCENT) * F.col("shared_a") >= PERCENT * (F.col("n_a") + least))
    return minor, side("b", "major").where(enough.format(x="b")).withColumn("level", _level(F.col("n_b")))


def _across(split: DataFrame, sets: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb) of a bucket that lie in different components, haven't been compared, and are plausible.

    Members of a bucket's largest component meet only members of the others, so a bucket of copies that are linked already costs
    nothing. Two bounds exclude most other pairs, and no linked one: shingles that one class alone has are in no intersection, and the
    parity bitmaps of whole sets differ in at most as many bits as the sets differ in shingles. The first is applied before the join.
    """
    alone = _alone(sets)
    shared = F.col("n") - F.coalesce("alone", F.lit(0))
    rows = split.withColumn("key", F.xxhash64("class")).join(alone, "key", "left").withColumn("shared", shared)
    minor, every = _sides(parked(rows.join(sets.select("class", "parity"), "class"), "sides"))
    # two members of minor components meet once
    meet = (F.col("component_a") < F.col("component_b")) | (F.col("component_b") == F.col("major"))
    bound = (100 + PERCENT) * F.least("shared_a", "shared_b") >= PERCENT * (F.col("n_a") + F.col("n_b"))
    met = minor.join(every, ["bucket", "level"]).where(F.col("component_a") != F.col("component_b")).where(meet & bound)
    # of n_a + n_b shingles, linked sets differ in (100 - PERCENT) / (100 + PERCENT) at most
    met = met.where((100 + PERCENT) * _different("parity_a", "parity_b", FULL_BITS) <= (100 - PERCENT) * (F.col("n_a") + F.col("n_b")))
    swap = F.col("class_a") < F.col("class_b")
    sizes = [F.when(swap, F.col(f"n_{y}")).otherwise(F.col(f"n_{x}")).alias(name) for x, y, name in (("a", "b", "na"), ("b", "a", "nb"))]
    pairs = met.select(F.greatest("class_a", "class_b").alias("a"), F.least("class_a", "class_b").alias("b"), *sizes).distinct()
    return parked(pairs.join(tested, ["a", "b"], "left_anti"), "across")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text; ``id`` is the doc_id).

    ``component_id`` is the least doc_id reachable over links (similarity of at least PERCENT). Null and empty texts and texts of white
    space have no shingles, are linked with nothing and are kept. Rows that repeat an id and a text share a component and are kept or
    not together; a null id belongs to its text's component and is kept only where no row of that has an id. An empty table gives an
    empty result. Links are found with the recall of BANDS bands: a pair of exactly 0.75 is missed about five times in a million.
    """
    rows = need(docs, "doc_id", "text").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    signed = rows.mapInArrow(_sign, f"id {rows.schema['id'].dataType.simpleString()}, n long, class binary, bands array<long>, sketch array<long>")
    signed = parked(signed, "signed")
    firsts = [F.first(c).alias(c) for c in ("n", "bands", "sketch")]
    reps = parked(signed.where("n > 0").groupBy("class").agg(F.min("id").alias("id"), *firsts), "classes")
    buckets = reps.select("class", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("class").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = parked(buckets.join(hubs, "bucket").select("bucket", "class", "hub"), "members")

    verifier = _Verifier(rows, reps)
    tested = members.where("class <> hub").select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct()
    links = verifier.linked(verifier.plausible(tested))
    labels = components(links)
    split = _split(members, labels, reps)
    sets = verifier.sets_of(split.select("class").distinct())
    more = verifier.linked(_across(split, sets, tested), sets)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    own = reps.select("class", "id").join(labels, F.col("class") == F.col("node"), "left")
    own = own.select("class", "id", F.coalesce("component", "class").alias("component"))
    least = own.groupBy("component").agg(F.min("id").alias("component_id"))
    named = own.join(least, "component").select("class", "component_id")
    shingled = signed.where("n > 0").join(named, "class").select("id", "n", "component_id")
    out = shingled.unionByName(signed.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select("id", F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
