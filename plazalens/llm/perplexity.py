"""Quality rules: counts of words, symbols and repetitions, and perplexity under an n-gram model of the corpus itself.

The model is modified Kneser-Ney over strings of ORDER bytes, none folded. Spark counts them over all distinct texts, and counts,
continuations, discounts and back-off weights stay tables that grow with the corpus. A byte's cost is judged as if the string that ends
there stood once less in the corpus, so that a text isn't held against itself. The cost of a text is shared by its content, which is all
but white space and SYMBOLS: marks between words cost, and don't dilute it. Each language has its own band of accepted perplexities.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.arrow import WHITE, Chunk, chunks, grams, mixed, text_column
from plazalens.llm.common import need, parked

ORDER = 6
SYMBOL_BITS = 8
MASK = (1 << SYMBOL_BITS) - 1
BLANK = 0x20
COUNT_BYTES = 256 << 20  # of text that one task counts, where there are more than the cores can share
HELD_GRAMS = 1 << 22  # different grams that a task holds before it sends them on
RANGE_GRAMS = 1 << 23  # grams whose costs are with a task at once; more are looked up in as many readings of the texts
CACHED = 1 << 20  # costs kept at hand in a task
SENT_ROWS = 1 << 16
SCORED_BYTES = 1 << 19  # of text scored at once
MIN_WORDS, MAX_REPEATED = 50, 50  # words, and percent of them in repeated windows
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"
# A band of log perplexity reaches RANGES interquartile ranges beyond the quartiles, LEAST at least, and further for short texts:
# one deviation of a mean over their letters, where one letter's cost deviates by DEVIATION. Chosen on documents of even id of sf0.1
RANGES, LEAST, DEVIATION = 4, 0.02, 1.3

_LINE = np.zeros(256, bool)
_LINE[0x0A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_CONTENT = ~WHITE & ~_SYMBOL
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80


def gram_ids(chunk: Chunk) -> np.ndarray:
    """The ORDER bytes that end at each byte, as a number; before a text's first byte there are blanks."""
    before = chunk.data.astype(np.int64)
    ids = before.copy()
    starts = chunk.ends[:-1]
    starts = starts[starts < len(before)]
    for back in range(1, ORDER):
        before = np.concatenate((np.full(1, BLANK, np.int64), before[:-1]))
        before[starts] = BLANK
        ids |= before << (SYMBOL_BITS * back)
    return ids


def _summed(found: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different grams, sorted, and the sums of their counts."""
    keys, counts = np.concatenate(found), np.concatenate(n)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, n, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def answer(keys, counts):
        for i in range(0, len(keys), SENT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + SENT_ROWS]), pa.array(counts[i : i + SENT_ROWS])], names=["gram", "n"])

    for batch in batches:
        for chunk in chunks(text_column(batch, "t")):
            ids = np.sort(gram_ids(chunk))
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
            found.append(ids[first])
            n.append(np.diff(np.concatenate((first, [len(ids)]))) if len(first) else first)
            size += len(first)
            if size > HELD_GRAMS:
                keys, counts = _summed(found, n)
                if 2 * len(keys) > HELD_GRAMS:  # a gram may be sent several times
                    yield from answer(keys, counts)
                    keys, counts = keys[:0], counts[:0]
                found, n, size = [keys], [counts], len(keys)
    yield from answer(*_summed(found, n))


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, n over all texts of ``docs``."""
    partial = need(docs, "text").select(F.col("text").alias("t")).mapInArrow(_count, "gram long, n long")
    return partial.groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(n: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from how many grams have counts 1 to 4; without the counts to estimate them, half a count."""
    if not all(n):
        return [0.5] * 3
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]


def _shorter(gram: Column, order: int) -> Column:
    return gram.bitwiseAND((1 << (SYMBOL_BITS * order)) - 1)


class Level:
    """The grams of one order: gram, p (of its last byte after the others), out (the same with the gram once less in the corpus), weight
    (of shorter grams after its context). ``size``: how many."""

    def __init__(self, counts: DataFrame, order: int, below: "Level | None"):
        kinds = counts.agg(F.count("*"), *[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
        self.order, self.size = order, kinds[0]
        one, two, more = map(F.lit, _discounts(list(kinds[1:])))
        n, zero = F.col("n"), F.lit(0.0)
        rows = counts.withColumns({
            "off": F.when(n == 1, one).when(n == 2, two).otherwise(more),
            "less": F.when(n == 1, zero).when(n == 2, one).when(n == 3, two).otherwise(more),  # were there one less
        })
        # a context has as many rows as there are bytes, at most
        context = Window.partitionBy(F.shiftright("gram", SYMBOL_BITS))
        rows = rows.withColumns({"total": F.sum("n").over(context), "mass": F.sum("off").over(context)})
        if below is None:
            rows = rows.withColumns({"low": F.lit(1.0 / (MASK + 1)), "low_out": F.lit(1.0 / (MASK + 1))})
        else:
            lower = below.table.select(F.col("gram").alias("_gram"), F.col("p").alias("low"), F.col("out").alias("low_out"))
            rows = rows.join(lower, _shorter(F.col("gram"), order - 1) == F.col("_gram"))
        total, mass, off, less = (F.col(c) for c in ("total", "mass", "off", "less"))
        rest = F.when(n == 1, F.col("low_out")).otherwise(F.col("low"))
        out = F.when(total == 1, rest).otherwise((n - 1 - less + (mass - off + less) * rest) / (total - 1))
        weight = mass / total
        self.table = rows.select("gram", ((n - off) / total + weight * F.col("low")).alias("p"), out.alias("out"), weight.alias("weight"))


class Model:
    """``levels``: a Level of each order; ``costs``: gram, cost (-log out) of all grams of ORDER bytes."""

    def __init__(self, counts: DataFrame):
        tables = [parked(counts, f"grams{ORDER}")]
        for order in range(ORDER - 1, 0, -1):  # distinct grams that end alike
            shorter = tables[0].groupBy(_shorter(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("n"))
            tables.insert(0, parked(shorter, f"grams{order}"))
        self.levels: list[tuple[Level]] = []
        below = None
        for order, table in enumerate(tables, 1):
            below = Level(table, order, below)
            if order < ORDER:
                below.table = parked(below.table, f"level{order}")
            self.levels.append((below,))
        self.costs = parked(below.table.select("gram", (-F.log("out")).cast("float").alias("cost")), "costs")

    def probability(self, order: int, ids: np.ndarray) -> np.ndarray:
        """Of the last byte after the ones before it. What reaches the driver is what is asked for."""
        if order == 0 or not len(ids):
            return np.full(len(ids), 1.0 / (MASK + 1))
        table = self.levels[order - 1][0].table
        context = F.shiftright("gram", SYMBOL_BITS)
        wanted = table.sparkSession.createDataFrame([(int(i),) for i in np.unique(ids)], "gram long")
        known = {r[0]: r[1] for r in table.join(wanted, "gram").select("gram", "p").collect()}
        asked = wanted.select(context.alias("c")).distinct()
        weights = {r[0]: r[1] for r in table.select(context.alias("c"), "weight").join(asked, "c").groupBy("c").agg(F.first("weight")).collect()}
        rest = [i for i in np.unique(ids).tolist() if i not in known]
        lower = self.probability(order - 1, np.array(rest, np.int64) & ((1 << (SYMBOL_BITS * (order - 1))) - 1))
        known |= {i: weights.get(i >> SYMBOL_BITS, 1.0) * p for i, p in zip(rest, lower.tolist())}
        return np.array([known[i] for i in ids.tolist()])

    def ranges(self) -> Iterator[DataFrame]:
        """``costs`` in parts of about RANGE_GRAMS rows."""
        parts = max(1, math.ceil(self.levels[-1][0].size / RANGE_GRAMS))
        for part in range(parts):
            yield self.costs.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == part) if parts > 1 else self.costs


class Costs:
    """Costs of one range of grams, looked up; what is asked for often is kept at hand. Grams of other ranges cost nothing here."""

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.costs = keys[order], costs[order]

    def cache(self) -> tuple[np.ndarray, np.ndarray]:
        return np.full(CACHED, -1, np.int64), np.zeros(CACHED, np.float32)

    def of(self, ids: np.ndarray, cache: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        held, values = cache
        slot = (mixed(ids.view(np.uint64)) & np.uint64(CACHED - 1)).astype(np.int64)
        out = values[slot]
        missed = np.flatnonzero(held[slot] != ids)
        if len(missed) and len(self.keys):
            wanted = ids[missed]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            cost = np.where(self.keys[at] == wanted, self.costs[at], np.float32(0))
            out[missed] = cost
            # of several grams in one slot the one written last must give both, gram and cost
            last = np.unique(slot[missed][::-1], return_index=True)
            took = missed[::-1][last[1]]
            held[last[0]], values[last[0]] = ids[took], out[took]
        elif len(missed):
            out[missed] = 0
        return out


def fit(docs: DataFrame) -> Model:
    """The model of all texts, as tables; the driver sees four sums an order."""
    return Model(count_grams(docs))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Each text of ``docs`` (text) once. Copies meet before the shuffle, so a large group of them is a row a task."""
    return need(docs, "text").where("text is not null").groupBy(F.md5("text").alias("h")).agg(F.first("text").alias("text")).select("text")


def _per_row(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[ends])


def _repeats(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value occurs more than once in its row, and the distinct values of each row."""
    row = np.repeat(np.arange(len(begins) - 1, dtype=np.uint64), np.diff(begins))
    own = mixed(hashes + mixed(row + np.uint64(1)))
    _, first, inverse, n = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    distinct = np.zeros(len(own), bool)
    distinct[first] = True
    return n[inverse] > 1, _per_row(distinct, begins)


def base_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    words, bounds = chunk.words()
    windows, begins = grams(words, bounds, REPEAT_WINDOW)
    again, _ = _repeats(windows, begins)
    covered = np.zeros(len(words) + 1, bool)
    at = np.repeat(bounds[:-1] - begins[:-1], np.diff(begins)) + np.arange(len(windows))
    for j in range(REPEAT_WINDOW):
        covered[at[again] + j] = True
    inside = ~WHITE[chunk.data]
    # lines are runs between \n; those of white space alone don't count
    starts, stops, lines, _ = chunk.spans(_LINE)
    hashes, _ = chunk.words(_LINE)
    seen = np.concatenate(([0], np.cumsum(inside)))
    solid = seen[stops] > seen[starts]
    solid_begins = np.concatenate(([0], np.cumsum(solid)))[lines]
    _, distinct = _repeats(hashes[solid], solid_begins)
    return {
        "n_words": np.diff(bounds),
        "word_chars": _per_row(inside & _STARTS_CHAR[chunk.data], chunk.ends),
        "n_symbols": _per_row(_SYMBOL[chunk.data], chunk.ends),
        "n_dup_lines": np.diff(solid_begins) - distinct,
        "n_repeat_words": _per_row(covered[:-1], bounds),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep``, the counts, and log_perplexity (null for texts without content) of every row of ``docs`` (text), which are read once for each range
    of the model's grams."""
    names = list(dict.fromkeys(keep))
    text = F.col("text").alias("t")
    rows = need(docs, *dict.fromkeys([*names, "text"])).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], F.md5("text").alias("h"), text)
    ranges = list(model.ranges())
    context = docs.sparkSession.sparkContext

    def costs(part: DataFrame):
        held = part.toArrow()
        return context.broadcast(Costs(held.column("gram").to_numpy(), held.column("cost").to_numpy()))

    def add_up(shared, whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, cache = shared.value, shared.value.cache()
            for batch in batches:
                counts, sums, sizes = [], [np.zeros(0)], [np.zeros(0, np.int64)]
                for chunk in chunks(text_column(batch, "t"), SCORED_BYTES):
                    total = np.zeros(len(chunk))
                    full = np.flatnonzero(np.diff(chunk.ends))
                    if len(full):
                        total[full] = np.add.reduceat(table.of(gram_ids(chunk), cache).astype(np.float64), chunk.ends[:-1][full])
                    sums.append(total)
                    if whole:
                        counts.append(base_counts(chunk))
                        sizes.append(_per_row(_CONTENT[chunk.data], chunk.ends))
                columns = [batch.column(c) for c in batch.schema.names if c != "t"]
                if whole:
                    columns += [pa.array(np.concatenate([c[n] for c in counts] or [np.zeros(0)]).astype(np.int64)) for n in COUNTS]
                    columns.append(pa.array(np.concatenate(sizes).astype(np.int64)))
                columns.append(pa.array(np.concatenate(sums)))
                yield pa.RecordBatch.from_arrays(columns, names=[*(c for c in batch.schema.names if c != "t"), *([*COUNTS, "content"] if whole else []), "cost"])

        return run

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "t"]
    out = rows.mapInArrow(add_up(costs(ranges[0]), True), ", ".join([*kept, *[f"{c} long" for c in COUNTS], "content long, cost double"]))
    more = [rows.where("h is not null").select("h", "t").mapInArrow(add_up(costs(r), False), "h string, cost double") for r in ranges[1:]]
    if more:
        # copies of a text cost the same
        more = [parked(m.groupBy("h").agg(F.first("cost").alias("cost")), "part-costs") for m in more]
        rest = more[0]
        for m in more[1:]:
            rest = rest.unionByName(m)
        rest = rest.groupBy("h").agg(F.sum("cost").alias("_rest"))
        out = out.join(rest, "h", "left").withColumn("cost", F.col("cost") + F.coalesce("_rest", F.lit(0.0)))
    log_perplexity = F.when(F.col("content") > 0, F.col("cost") / F.col("content")).alias("log_perplexity")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)], *COUNTS, log_perplexity)


def judged(measured: DataFrame, language: str, text_hash: str) -> DataFrame:
    """``measured`` with base_failed, lower and upper (bounds of log perplexity for the row's ``language``) and kept.

    Rows of equal ``text_hash`` count once in their language's quartiles.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = measured.withColumn("base_failed", failed).withColumn("_lang", F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")))
    once = rows.where("not base_failed").groupBy("_lang", text_hash).agg(F.first("log_perplexity").alias("log_perplexity"))
    quartiles = once.groupBy("_lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("q"))
    q1, q2, q3 = (F.get("q", i) for i in range(3))
    reach = F.greatest(F.lit(RANGES) * (q3 - q1), F.lit(LEAST))
    bands = quartiles.select("_lang", (q1 - reach).alias("lower"), (q3 + reach).alias("upper"))
    slack = F.lit(DEVIATION) / F.sqrt(F.greatest(F.col("word_chars") - F.col("n_symbols"), F.lit(1)))
    out = rows.join(bands, "_lang", "left").withColumns({"lower": F.col("lower") - slack, "upper": F.col("upper") + slack}).drop("_lang")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & inside)


def quality(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the counts, log_perplexity, base_failed, lower, upper, kept of every row of ``docs`` (text, lang).

    Null and empty texts count nothing and fail; a text without content isn't kept; a null language is one of its own; repeated rows repeat, but a text counts once in the
    model and in its language's band; an empty table gives an empty result. Texts are read whole: for their size, by the model, and once for
    each range of its grams.
    """
    rows = need(docs, *dict.fromkeys([*keep, "lang", "text"])).withColumn("_text_md5", F.md5("text"))
    # few tasks count, as each sends most grams of the language; a task's share of the texts is bounded
    size = need(docs, "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(size / COUNT_BYTES))
    model = fit(distinct_texts(docs).coalesce(tasks))
    measured = parked(measure(rows, model, *dict.fromkeys([*keep, "lang", "_text_md5"])), "measured")
    out = judged(measured, "lang", "_text_md5")
    return out.select(*[F.col(f"`{c}`") for c in dict.fromkeys(keep)], *COUNTS, "log_perplexity", "base_failed", "lower", "upper", "kept")
