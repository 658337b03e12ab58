"""Phrase collocations: the best scored phrases of two to four words of each language.

Phrases grow best first from their prefixes. A phrase of count a whose first word has count f scores at most 2000000 * a / (f + a), and no
phrase that continues it scores more, so prefixes below a language's threshold stay unexpanded (likewise from the last word backwards).
The threshold starts where pairs alone would fill the list a few times over and falls until enough phrases at or above it survive.

Tasks count grams of word hashes of whole batches; what may be skipped is told by Bloom filters of bounded size. A filter that lets too much
through costs time only: every gram that counts in the result is counted in full. Two words of one hash are found out and hashed anew.
"""

from collections.abc import Callable, Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.arrow import BASE, LOWERED, PLACE_CODES, Chunk, chunks, mixed, powers, text_column
from plazalens.llm.common import need, parked

LEAST = 30  # occurrences of a candidate
SCALE = 2_000_000
SHARE = 80  # percent of a candidate's occurrences inside a longer one that drop it
TOP = 2000
SLACK, STEP = 2, 8  # the first threshold is the pair of rank SLACK * TOP, each further one of STEP times that rank
FILTER_BITS = 1 << 28  # of a filter at most, 16 an entry below that
PENDING = 1 << 20  # grams a task holds before it sums them up
CHUNK = 1 << 20  # bytes of text worked on at once; a longer text is a chunk of its own
CHECK_SEED = 1 << 20  # apart from the seeds tried for the first hash
SPREAD = 256  # parts a language is ranked in before the best of each are ranked together

APART = np.zeros(256, bool)
APART[[0x20, 0x09]] = True
PIECE = np.zeros(256, bool)
PIECE[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True


# ---------------------------------------------------------------- words and grams of a chunk


@cache
def _codes(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _lang_code(lang: str, seed: int) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(f"{seed}|{lang}".encode(), digest_size=8).digest(), "big"))


class Words:
    """The words of a chunk in order: their hashes, which differ by language, and whether the next word continues the piece."""

    def __init__(self, chunk: Chunk, langs: list[str], seed: int):
        self.starts, self.stops, bounds, inside = chunk.spans(APART | PIECE)
        self.rows = np.repeat(np.arange(len(chunk)), np.diff(bounds))
        self.data = LOWERED[chunk.data]
        lengths = self.stops - self.starts
        if not len(lengths):
            self.hashes, self.joined = np.zeros(0, np.uint64), np.zeros(0, bool)
            return
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
        sums = np.add.reduceat(_codes(seed)[self.data[inside]] * powers(int(lengths.max()))[place], begin)
        salt = np.array([_lang_code(x, seed) for x in langs], np.uint64)
        self.hashes = mixed(sums + lengths.astype(np.uint64) * BASE + salt[self.rows])
        piece = np.cumsum(PIECE[chunk.data])[self.starts]
        self.joined = (piece[1:] == piece[:-1]) & (self.rows[1:] == self.rows[:-1])

    def texts(self, which: np.ndarray) -> pa.Array:
        starts, lengths = self.starts[which], (self.stops - self.starts)[which]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.data[at])]
        return pa.Array.from_buffers(pa.large_string(), len(which), buffers)


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for j, c in enumerate(columns):
        out += c * PLACE_CODES[j]
    return mixed(out)


def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Equal grams as one: columns, counts, and the index of the first of each. Grams of one hash by chance stay apart."""
    hashes = gram_hash(columns)
    order = np.argsort(hashes, kind="stable")
    parts = [c[order] for c in columns]
    differ = [c[1:] != c[:-1] for c in parts]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce(differ)
    if np.any(new[1:] & (np.diff(hashes[order]) == 0)):
        order = np.lexsort(columns)
        parts = [c[order] for c in columns]
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in parts])
    first = np.flatnonzero(new)
    totals = np.add.reduceat(counts[order], first) if len(first) else counts
    return [c[first] for c in parts], totals, order[first]


# ---------------------------------------------------------------- filters


class Filter:
    """A Bloom filter; ``has`` is never false for a member."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        mask = np.uint64(size - 1)
        return [mixed(hashes + PLACE_CODES[j]) & mask for j in range(3)]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self.places(hashes, len(self.bits) * 64):
            out &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def built(grams: DataFrame, columns: list[str]) -> Filter:
    """The filter of a table's grams. Tasks set the bits of their rows; the driver sees the bits alone, 32 MB at most."""
    size = 1 << 16
    n = grams.count()
    while size < min(16 * n, FILTER_BITS):
        size *= 2

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = gram_hash([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns])
            at = np.unique(np.concatenate(Filter.places(hashes, size)))
            if len(at):
                words, first = np.unique(at >> np.uint64(6), return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.record_batch([pa.array(words.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    set_words = grams.select(*columns).mapInArrow(set_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = set_words.toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Filter(bits)


# ---------------------------------------------------------------- counting


def _langs(batch: pa.RecordBatch, chunk: Chunk) -> list[str]:
    return batch.column("lang").slice(chunk.first, len(chunk)).to_pylist()


def _count_words(seed: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(text_column(batch, "text"), CHUNK):
                words = Words(chunk, _langs(batch, chunk), seed)
                # a second hash, or else words of one chunk and one hash would hide each other
                check = Words(chunk, _langs(batch, chunk), seed + CHECK_SEED).hashes
                (hashes, _), counts, first = summed([words.hashes, check], np.ones(len(check), np.int64))
                langs = np.array(_langs(batch, chunk), object)[words.rows[first]]
                yield pa.record_batch(
                    [pa.array(hashes.view(np.int64)), pa.array(langs, pa.string()), words.texts(first).cast(pa.string()), pa.array(counts)],
                    ["h", "lang", "word", "n"],
                )

    return count


def _count_grams(m: int, seed: int, chosen: Callable) -> Callable:
    """Counts the grams of ``m`` words that begin where ``chosen(hashes)`` says; their pieces are seen to here."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        pending = 0

        def out(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(c.view(np.int64)) for c in columns] + [pa.array(counts)]
            return pa.record_batch(arrays, [*_names(m), "n"])

        def together() -> tuple[list[np.ndarray], np.ndarray]:
            columns = [np.concatenate([c[j] for c, _ in held]) for j in range(m)]
            return summed(columns, np.concatenate([n for _, n in held]))[:2]

        for batch in batches:
            for chunk in chunks(text_column(batch, "text"), CHUNK):
                words = Words(chunk, _langs(batch, chunk), seed)
                n = len(words.hashes) - m + 1
                if n <= 0:
                    continue
                here = np.logical_and.reduce([words.joined[j : j + n] for j in range(m - 1)])
                at = np.flatnonzero(here & chosen(words.hashes))
                if not len(at):
                    continue
                held.append(([words.hashes[at + j] for j in range(m)], np.ones(len(at), np.int64)))
                pending += len(at)
                if pending >= PENDING:
                    held = [together()]
                    pending = len(held[0][1])
                    if pending >= PENDING // 2:
                        yield out(*held.pop())
                        pending = 0
        if held:
            yield out(*together())

    return count


def _names(m: int, first: int = 1) -> list[str]:
    return [f"w{j}" for j in range(first, first + m)]


def _grams(texts: DataFrame, m: int, seed: int, chosen: Callable) -> DataFrame:
    """w1..wm, a of all chosen grams found often enough."""
    types = ", ".join(f"{c} long" for c in [*_names(m), "n"])
    counted = texts.mapInArrow(_count_grams(m, seed, chosen), types).groupBy(*_names(m)).agg(F.sum("n").alias("a"))
    return counted.where(F.col("a") >= LEAST)


def _of_words(words) -> Callable:
    def chosen(hashes: np.ndarray) -> np.ndarray:
        often = words.value.has(gram_hash([hashes]))
        return often[:-1] & often[1:]

    return chosen


def _of_pairs(often, up, down) -> Callable:
    """Triples of two frequent pairs, one of which may be part of a phrase at the threshold."""

    def chosen(hashes: np.ndarray) -> np.ndarray:
        pairs = gram_hash([hashes[:-1], hashes[1:]])
        known = often.value.has(pairs)
        grows, ends = known & up.value.has(pairs), known & down.value.has(pairs)
        return (grows[:-1] & known[1:]) | (known[:-1] & ends[1:])

    return chosen


def _of_triples(found, up, down) -> Callable:
    """Quads that may reach the threshold themselves, or continue a triple that does."""

    def chosen(hashes: np.ndarray) -> np.ndarray:
        triples = gram_hash([hashes[:-2], hashes[1:-1], hashes[2:]])
        at, grows, ends = found.value.has(triples), up.value.has(triples), down.value.has(triples)
        return at[:-1] | at[1:] | (grows[:-1] & ends[1:])

    return chosen


# ---------------------------------------------------------------- scores


def _ratio(a: str, total: str) -> Column:
    """floor(SCALE * a / total), exact."""
    return F.expr(f"cast(cast({a} as decimal(19, 0)) * {SCALE} div ({total}) as bigint)")


def _scored(rows: DataFrame, cuts: list[tuple[str, str]], last: str) -> DataFrame:
    """Adds l, r, score of the cut that scores least, and what longer phrases can score that begin (up) or end (down) so. Of missing
    counts there is no score."""
    known = " and ".join(f"{l} is not null and {r} is not null" for l, r in cuts)
    each = [F.struct(_ratio("a", f"{l} + {r}").alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, (l, r) in enumerate(cuts)]
    least = F.when(F.expr(known), F.array_min(F.array(*each)))
    rows = rows.withColumn("_cut", least).withColumn("up", _ratio("a", "f1 + a")).withColumn("down", _ratio("a", f"{last} + a"))
    return rows.select("*", "_cut.l", "_cut.r", "_cut.score").drop("_cut")


def _renamed(rows: DataFrame, **names: str) -> DataFrame:
    return rows.select(*[F.col(old).alias(new) for new, old in names.items()])


def _swallowed(rows: DataFrame, longer: DataFrame, m: int) -> DataFrame:
    """``rows`` (of m words) without those that a phrase of one word more holds nearly always. A phrase longer still is within one of these."""
    names = _names(m)
    sides = [longer.select(*names, "a"), longer.select(*[F.col(f"w{j + 1}").alias(f"w{j}") for j in range(1, m + 1)], "a")]
    most = sides[0].unionByName(sides[1]).groupBy(*names).agg(F.max("a").alias("most"))
    kept = rows.join(most, names, "left").where(F.expr(f"most is null or cast(most as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {SHARE}"))
    return kept.drop("most")


def _thresholds(pairs: DataFrame, langs: DataFrame | None, rank: int) -> DataFrame:
    """lang, theta: the score of the pair of that rank, 0 if there are fewer. Scores are whole numbers up to SCALE / 2, so a language is
    that many rows at most."""
    if langs is not None:
        pairs = pairs.join(langs, "lang", "left_semi")
    counts = pairs.groupBy("lang", "score").agg(F.count("*").alias("c"))
    above = F.sum("c").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    reached = counts.select("lang", F.when(above >= rank, F.col("score")).otherwise(0).alias("score"))
    return reached.groupBy("lang").agg(F.max("score").alias("theta"))


def _first(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """``rank`` (from 1) of each language's first rows. No task ranks a whole language, but the first of its parts."""
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    within = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    rows = rows.withColumn("_part", part).withColumn("_at", within).where(F.col("_at") <= top).drop("_part", "_at")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


# ---------------------------------------------------------------- the operator


def word_counts(texts: DataFrame) -> tuple[DataFrame, int]:
    """h, lang, word, f of all words, written, and the seed under which no two of them have one hash."""
    seed = 0
    while True:
        counted = texts.mapInArrow(_count_words(seed), "h long, lang string, word string, n long")
        found = parked(counted.groupBy("h", "lang", "word").agg(F.sum("n").alias("f")), "words")
        if found.groupBy("h").count().where("count > 1").isEmpty():
            return found, seed
        seed += 1


def collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first TOP phrases of each language.

    Texts are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line ends; words stand apart by blanks and tabs. A null language is
    ``und``, like one of that name; a null text has no words. Rows that repeat count as often as they are there. Ties in score go by count,
    then by phrase in byte order, so ranks have none. A language without a phrase of LEAST occurrences is left out, as is an empty table.
    Only ``lang`` and ``text`` are read of the input.
    """
    spark = docs.sparkSession
    texts = need(docs, "lang", "text").select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    words, seed = word_counts(texts)
    often = words.where(F.col("f") >= LEAST)
    share = lambda grams, names: spark.sparkContext.broadcast(built(grams, names))

    pairs = _grams(texts, 2, seed, _of_words(share(often, ["h"])))
    pairs = pairs.join(_renamed(often, w1="h", f1="f", lang="lang"), "w1").join(_renamed(often, w2="h", f2="f"), "w2")
    pairs = parked(_scored(pairs, [("f1", "f2")], "f2"), "pairs")

    settled: list[DataFrame] = []
    open_langs, rank = None, SLACK * TOP
    while True:
        theta = parked(_thresholds(pairs, open_langs, rank), "thresholds")
        if theta.isEmpty():
            break
        here = pairs.join(theta, "lang")
        reach = F.col("score") >= F.col("theta")
        two = [share(here.where(c), _names(2)) for c in ("true", "up >= theta", "down >= theta")]
        own = texts.join(theta, "lang", "left_semi")

        triples = _grams(own, 3, seed, _of_pairs(*two))
        triples = triples.join(_renamed(pairs, w1="w1", w2="w2", a12="a", f1="f1", lang="lang"), _names(2))
        triples = triples.join(_renamed(pairs, w2="w1", w3="w2", a23="a", f3="f2"), _names(2, 2))
        triples = parked(_scored(triples, [("f1", "a23"), ("a12", "f3")], "f3").join(theta, "lang"), "triples")
        three = [share(triples.where(c), _names(3)) for c in ("score >= theta", "up >= theta", "down >= theta")]

        quads = _grams(own, 4, seed, _of_triples(*three))
        quads = quads.join(_renamed(pairs, w1="w1", w2="w2", a12="a", f1="f1", lang="lang"), _names(2))
        quads = quads.join(_renamed(pairs, w3="w1", w4="w2", a34="a", f4="f2"), _names(2, 3))
        quads = quads.join(_renamed(triples, w1="w1", w2="w2", w3="w3", a123="a"), _names(3), "left")
        quads = quads.join(_renamed(triples, w2="w1", w3="w2", w4="w3", a234="a"), _names(3, 2), "left")
        quads = parked(_scored(quads, [("f1", "a234"), ("a12", "a34"), ("a123", "f4")], "f4").join(theta, "lang"), "quads")

        survivors = quads.where(reach).select("lang", *_names(4), "a", "l", "r", "score", "theta")
        for rows, longer, m in ((here, triples, 2), (triples, quads, 3)):
            left = _swallowed(rows.where(reach), longer, m)
            blank = [F.lit(None).cast("long").alias(c) for c in _names(4 - m, m + 1)]
            survivors = survivors.unionByName(left.select("lang", *_names(m), *blank, "a", "l", "r", "score", "theta"))
        survivors = parked(survivors, "survivors")

        enough = survivors.groupBy("lang").agg(F.count("*").alias("found"))
        state = theta.join(enough, "lang", "left")
        done = F.expr(f"theta = 0 or coalesce(found, 0) >= {TOP}")
        settled.append(survivors.join(state.where(done).select("lang"), "lang", "left_semi"))
        open_langs = state.where(~done).select("lang")
        if open_langs.isEmpty():
            break
        rank *= STEP

    if not settled:
        types = {"lang": "string", "phrase": "string"}
        names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        return spark.createDataFrame([], ", ".join(f"{c} {types.get(c, 'long')}" for c in names))
    found = settled[0]
    for x in settled[1:]:
        found = found.unionByName(x)
    for j in range(1, 5):
        found = found.join(_renamed(often, **{f"w{j}": "h", f"t{j}": "word"}), f"w{j}", "left")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = found.select("lang", F.concat_ws(" ", "t1", "t2", "t3", "t4").alias("phrase"), "a", "l", "r", "score")
    found = _first(found, [F.desc("score"), F.desc("a"), F.asc("phrase")], TOP)
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
