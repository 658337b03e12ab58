"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language reads a text by longest matches. The language that needs the fewest phrases, each
charged with what it costs to name it, explains the text best.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import need

EXCERPTS = 80  # labelled excerpts of a language, about, at most; with many languages each gets fewer
ALL_EXCERPTS = 1600  # of all languages together, about, at most twice as many: this bounds the model
EXCERPT_CHARS = 400  # of each
PIECE = 256  # characters read in one go; a phrase ends where a piece ends
CELLS = 1 << 20  # characters worked on at once
LETTERS = 256  # symbols of the automata at most; rarer ones share the last
UND = "und"
A_LETTER = r"\p{L}"


def is_training(doc_id: Column) -> Column:
    """Rows a model may learn from: crc32 of the id as text, modulo 5, is not 0. Null ids count as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0, F.lit(False))


def labelled_excerpts(docs: DataFrame, excerpts: int = EXCERPTS, chars: int = EXCERPT_CHARS) -> pd.DataFrame:
    """lang, excerpt: about ``excerpts`` of each language (fewer if there are very many), from anywhere in its texts.

    ``docs`` are the labelled rows (text, lang). Texts are drawn by hash, equal texts once, so the sample's size depends neither on
    the rows nor on copies.
    """
    mark = F.xxhash64("text")
    seen = docs.where(F.col("text").rlike(A_LETTER)).select("lang", "text", mark.alias("mark"))
    counts = seen.groupBy("lang").agg(F.approx_count_distinct("mark", 0.02).alias("texts"))
    sizes = {r["lang"]: r["texts"] for r in counts.collect()}  # a row for each language
    excerpts = max(1, min(excerpts, ALL_EXCERPTS // max(1, len(sizes))))
    rates = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(1.3 * excerpts / max(1, n)))] or [F.lit(""), F.lit(0.0)])
    unit = F.pmod(F.xxhash64(F.col("mark"), F.lit(1)), F.lit(1 << 40).cast("long")) / F.lit(float(1 << 40))
    drawn = seen.where(unit < F.element_at(rates, F.col("lang")))
    room = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.col("mark"), F.lit(2)), room.cast("long")).cast("int") + 1
    cut = drawn.select("lang", "mark", F.substring("text", start, F.lit(chars)).alias("excerpt"))
    cut = cut.groupBy("lang", "mark").agg(F.first("excerpt").alias("excerpt"))
    best = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    return cut.withColumn("_n", best).where(F.col("_n") <= 2 * excerpts).select("lang", "excerpt").toPandas()


def folded(text: str) -> str:
    """Lower case, with a single blank for what is no letter."""
    return "".join(c if c.isalpha() else " " for c in text.lower())


class Automaton:
    """Suffix automaton of a text over small integers, as one table ``state * width + symbol -> 2 * next state + restarted``.

    Where a match can't go on, the table already holds the step from the root, marked as the start of a new phrase.
    """

    def __init__(self, symbols: list[int], width: int):
        length, link, steps = [0], [-1], [{}]
        last = 0
        for c in symbols:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            steps.append({})
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = new
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    steps.append(dict(steps[q]))
                    while p >= 0 and steps[p].get(c) == q:
                        steps[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        table = np.full((len(length), width), -1, np.int32)
        for state, own in enumerate(steps):
            for c, to in own.items():
                table[state, c] = 2 * to
        root = np.where(table[0] < 0, 0, table[0]) | 1  # an unknown symbol is a phrase of its own
        self.table = np.where(table < 0, root[None, :], table).astype(np.int32).ravel()
        self.cost = math.log2(len(length) + 1)


class Model:
    """Automata of all languages over one alphabet: the commonest letters of the sample; others share a symbol."""

    def __init__(self, sample: pd.DataFrame):
        texts = {lang: " ".join(map(folded, rows["excerpt"])) for lang, rows in sample.sort_values("excerpt").groupby("lang")}
        self.langs = sorted(texts)
        seen = pd.Series(list("".join(texts.values()))).value_counts()
        known = sorted(sorted(seen.index, key=lambda c: (-seen[c], c))[: LETTERS - 2])
        letters = [c for c in known if c != " "]
        self.width = len(letters) + 2
        self.symbol = np.full(0x110000, self.width - 1, np.uint8)
        for i, c in enumerate(letters):
            self.symbol[ord(c)] = i + 1
        self.blank = 0
        self.symbol[~np.array([chr(c).isalpha() for c in range(0x110000)], bool)] = self.blank
        self.automata = [Automaton(self._symbols(texts[lang]), self.width) for lang in self.langs]

    def _symbols(self, text: str) -> list[int]:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases each language needs for each text, and the letters of each text."""
        codes, sizes = [], []
        for text in texts:
            a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            codes.append(a)
            sizes.append(len(a))
        flat = self.symbol[np.concatenate(codes)] if codes else np.zeros(0, np.uint8)
        owner = np.repeat(np.arange(len(texts)), sizes)
        # what is no letter is one blank
        first = np.ones(len(flat), bool)
        first[1:] = owner[1:] != owner[:-1]
        stay = flat != self.blank
        stay[1:] |= ~first[1:] & (flat[:-1] != self.blank)
        flat, owner = flat[stay], owner[stay]
        letters = np.bincount(owner[flat != self.blank], minlength=len(texts))
        out = np.zeros((len(self.langs), len(texts)), np.int64)
        if not len(flat):
            return out, letters
        # pieces of one text each, longest first: at every step those that go on are a prefix
        lengths = np.bincount(owner, minlength=len(texts))
        per = -(-lengths // PIECE)
        piece_of = np.repeat(np.arange(len(texts)), per)
        at = np.repeat(np.cumsum(lengths) - lengths, per) + PIECE * (np.arange(len(piece_of)) - np.repeat(np.cumsum(per) - per, per))
        size = np.minimum(PIECE, np.repeat(np.cumsum(lengths), per) - at)
        order = np.argsort(-size, kind="stable")
        at, size, piece_of = at[order], size[order], piece_of[order]
        going = np.searchsorted(-size, -np.arange(PIECE), "left")
        for k, automaton in enumerate(self.automata):
            state, count = np.zeros(len(at), np.int32), np.ones(len(at), np.int32)
            for step in range(int(size[0])):
                n = going[step]
                to = automaton.table[state[:n] * self.width + flat[at[:n] + step]]
                count[:n] += to & 1
                state[:n] = to >> 1
            out[k] = np.bincount(piece_of, count, minlength=len(texts)).astype(np.int64)
        return out, letters

    def judge(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text. The score is the share of the best language when each bit halves the odds."""
        if not texts:
            return [], []
        counts, letters = self.phrases(texts)
        if not self.langs:
            return [UND] * len(texts), [0.0] * len(texts)
        bits = counts * np.array([a.cost for a in self.automata])[:, None]
        best = np.argmin(bits, axis=0)
        odds = np.exp2(-np.minimum((bits - bits.min(axis=0)) / 4, 1000)).sum(axis=0)
        langs = [self.langs[b] if n else UND for b, n in zip(best, letters)]
        return langs, np.where(letters > 0, 1 / odds, 0.0).tolist()


def fit(docs: DataFrame) -> Model:
    """A model of the training rows of ``docs`` (doc_id, text, lang) that have a language; empty if there are none."""
    rows = need(docs, "doc_id", "text", "lang").where("lang is not null and text is not null").where(is_training(F.col("doc_id")))
    return Model(labelled_excerpts(rows))


def identify(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep``, lang_pred and score of every row of ``docs`` (text).

    A null text, an empty one, or one without a letter is ``und`` with score 0, as is every text if nothing was learned; of equally
    good languages the first by code point is taken; repeated rows repeat; an empty table gives an empty result. Whole texts are read, in
    pieces. Only the text goes into a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(dict.fromkeys(keep))
    rows = need(docs, *dict.fromkeys([*names, "text"]))
    rows = rows.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], F.col("text").alias("t"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            held, cells = [], 0
            for text in batch.column("t"):
                held.append(text.as_py() or "")
                cells += len(held[-1])
                if cells >= CELLS:
                    a, b = shared.value.judge(held)
                    langs, scores, held, cells = langs + a, scores + b, [], 0
            a, b = shared.value.judge(held)
            columns = [batch.column(f"k{i}") for i in range(len(names))]
            columns += [pa.array(langs + a, pa.string()), pa.array(scores + b, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*[f"k{i}" for i in range(len(names))], "lang_pred", "score"])

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "t"], "lang_pred string", "score double"])
    out = rows.mapInArrow(predict, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)], "lang_pred", "score")
