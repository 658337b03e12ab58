"""Removal of repeated byte strings, by run-length indexes of the places where texts can repeat.

A place is the DEPTH bytes that begin there. The least gram hash within a place, its anchor, is the same wherever the same bytes stand.
Runs of places with one anchor are segments; equal segments are one, at their earliest position. Segments whose anchor occurs only once
can't repeat. The others are gathered by anchor and each block becomes a run-length Burrows-Wheeler index, through which its
segments are streamed to find the places that occur again. An anchor with very many different segments is cut finer, by the bytes that
neighbouring places share, so that no block grows with the corpus.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.arrow import BASE, BYTE_CODES, mixed, powers
from plazalens.llm.common import need, parked
from plazalens.llm.rindex import RunIndex
from plazalens.llm.urls import passing

DEPTH = 100  # bytes of a repeated string
GRAM = 40
GRAMS = DEPTH - GRAM + 1  # in a place
CROWDED = 1000  # different segments of an anchor, beyond which it is cut finer
FINE = 4  # neighbouring places in a finer block
INDEX_BYTES = 2 << 20  # of a run-length index, about
BATCH_ROWS = 1 << 15  # segments sent on at once, about
LAST = (1 << 63) - 1  # null ids come after all others
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_HELD = 1 << 16  # powers kept between texts; a longer text has its own
_powers, _held_inverses = powers(_HELD), np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(_HELD - 1, _INVERSE))))


def _prefix(data: np.ndarray) -> np.ndarray:
    """Sums of byte codes times powers of BASE, one more than there are bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * (_powers[: len(data)] if len(data) <= _HELD else powers(len(data))), out=sums[1:])
    return sums


def _inverses(n: int) -> np.ndarray:
    if 0 < n <= _HELD:
        return _held_inverses[:n]
    out = np.full(max(n, 1), _INVERSE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _spread(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` values in a row."""
    now, have = values, 1
    while 2 * have <= width:
        now = pick(now[:-have], now[have:])
        have *= 2
    return pick(now[: len(values) - width + 1], now[width - have :]) if width > have else now


def grams_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all grams, the anchor of every place, prefix sums. ``data`` has DEPTH bytes at least."""
    sums = _prefix(data)
    n = len(data) - GRAM + 1
    hashes = mixed((sums[GRAM:] - sums[:n]) * _inverses(n))
    return hashes, _spread(hashes, GRAMS, np.minimum), sums


def _whole(least: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places lie within one of the texts that end at ``ends``; the anchors of the others become 0."""
    whole = np.ones(len(least), bool)
    for end in ends[:-1].tolist():
        whole[max(end - DEPTH + 1, 0) : end] = False
    least[~whole] = 0
    return whole


def _at_anchors(hashes: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Where the grams stand that are the least of some place."""
    around = np.concatenate((np.zeros(GRAMS - 1, np.uint64), least, np.zeros(GRAMS - 1, np.uint64)))
    return np.flatnonzero(hashes == _spread(around, GRAMS, np.maximum))


def anchors(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the grams that are the least of some place, each as often as it stands in the texts. ``data`` holds texts of DEPTH
    bytes at least, laid end to end; ``ends`` tells where each ends."""
    hashes, least, _ = grams_of(data)
    _whole(least, ends)
    return hashes[_at_anchors(hashes, least)]


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """text number, anchor, start in the text, length, hash, and whether the anchor stands in it more than once, of all segments of texts
    that are laid end to end."""
    hashes, least, sums = grams_of(data)
    whole = _whole(least, ends)
    same = (least[1:] == least[:-1]) & whole[1:] & whole[:-1]
    start = np.flatnonzero(whole & np.concatenate(([True], ~same)))
    stop = np.flatnonzero(whole & np.concatenate((~same, [True]))) + DEPTH
    anchor = least[start]
    content = mixed((sums[stop] - sums[start]) * _inverses(len(data) + 1)[start] + (stop - start).astype(np.uint64))
    # grams that are anchors, counted by segment
    at = _at_anchors(hashes, least)
    values, rank = np.unique(hashes[at], return_inverse=True)
    several = np.zeros(len(start), bool)
    if len(values) < len(at):
        width = len(data) + 1
        keys = np.sort(rank * width + at)
        own = np.searchsorted(values, anchor) * width
        several = np.searchsorted(keys, own + stop - GRAM, "right") - np.searchsorted(keys, own + start) > 1
    text = np.searchsorted(ends, start, "right")
    return text, anchor, start - np.concatenate(([0], ends))[text], stop - start, content, several


def _bytes(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8)


def _together(column: pa.Array) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Row numbers, bytes and ends of texts of DEPTH bytes or more, as many at a time as the held powers last."""
    rows, held, size = [], [], 0
    for row, t in enumerate(column):
        data = _bytes(t)
        if len(data) < DEPTH:
            continue
        if held and size + len(data) >= _HELD:
            yield rows, np.concatenate(held), np.cumsum([len(d) for d in held])
            rows, held, size = [], [], 0
        rows.append(row)
        held.append(data)
        size += len(data)
    if held:
        yield rows, np.concatenate(held), np.cumsum([len(d) for d in held])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [anchors(data, ends) for _, data, ends in _together(batch.column("t"))]
        values, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["anchor", "n"])


_SEGMENT = "doc long, tie long, anchor long, start long, length long, content long, several boolean"


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [p.split()[0] for p in _SEGMENT.split(", ")]

    def answer(found):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)

    held, rows = [], 0
    for batch in batches:
        docs, ties = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
        for numbers, data, ends in _together(batch.column("t")):
            text, anchor, start, length, content, several = segments(data, ends)
            of = np.array(numbers)[text]
            held.append((docs[of], ties[of], anchor.view(np.int64), start, length, content.view(np.int64), several))
            rows += len(of)
            if rows >= BATCH_ROWS:
                yield answer(held)
                held, rows = [], 0
    if held:
        yield answer(held)


def _finer(data: np.ndarray, anchor: int) -> Iterator[tuple[int, int, int]]:
    """(block, first, stop) of the parts of a segment's bytes: up to FINE neighbouring places whose anchor is the same gram."""
    hashes, least, sums = grams_of(data)
    at = np.flatnonzero(hashes == np.int64(anchor).astype(np.uint64))
    place = np.arange(len(least))
    gram = at[np.searchsorted(at, place)]  # the first one within each place
    group = (gram - place) // FINE
    begin = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (group[1:] != group[:-1]))))
    for first, after in zip(begin, np.concatenate((begin[1:], [len(place)]))):
        g = int(group[first])
        low = int(gram[first]) - g * FINE  # what all places of the group have in common
        core = hashlib.blake2b(data[low : low + DEPTH - FINE + 1].tobytes() + bytes([g]), digest_size=8).digest()
        yield int.from_bytes(core, "big", signed=True), int(first), int(after) - 1 + DEPTH


_PIECE = "block long, doc long, tie long, start long, bytes binary, crowded boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [p.split()[0] for p in _PIECE.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]

    def answer(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    out, size = [], 0
    for batch in batches:
        wanted = batch.column("wanted")
        asked = wanted.flatten()
        starts, lengths, anchor, crowded = (asked.field(asked.type.get_field_index(f)).to_pylist() for f in ("start", "length", "anchor", "crowded"))
        at = np.concatenate(([0], np.cumsum(wanted.value_lengths().to_numpy(zero_copy_only=False)))).tolist()
        docs, ties = batch.column("doc").to_pylist(), batch.column("tie").to_pylist()
        for row, t in enumerate(batch.column("t")):
            data, doc, tie = _bytes(t), docs[row], ties[row]
            for i in range(at[row], at[row + 1]):
                start, stop = starts[i], starts[i] + lengths[i]
                if crowded[i]:
                    found = _finer(data[start:stop], anchor[i])
                    new = [(b, doc, tie, start + f, data[start + f : start + a].tobytes(), True) for b, f, a in found]
                else:
                    new = [(anchor[i], doc, tie, start, data[start:stop].tobytes(), False)]
                out += new
                size += sum(len(n[4]) for n in new)
            if size >= INDEX_BYTES:
                yield answer(out)
                out, size = [], 0
    if out:
        yield answer(out)


def repeats_in(strings: list[np.ndarray], doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """string number, first and stop (in the text) of the runs of places that occur earlier in these strings."""
    index = RunIndex(strings, DEPTH)
    places, interval = index.stream()
    owner = np.searchsorted(index.stop, places)
    at = start[owner] + places - index.begin[owner]
    order = np.lexsort((at, tie[owner], doc[owner], interval))
    owner, at, interval = owner[order], at[order], interval[order]
    # the earliest stays, and so does the same place seen in another piece
    head = np.concatenate(([True], interval[1:] != interval[:-1])) if len(order) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = ~((doc[owner] == doc[owner[lead]]) & (tie[owner] == tie[owner[lead]]) & (at == at[lead]))
    owner, at = owner[later], at[later]
    order = np.lexsort((at, owner))
    owner, at = owner[order], at[order]
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)))) if len(at) else np.zeros(0, np.int64)
    last = np.concatenate((new[1:], [len(at)]))[: len(new)] - 1
    return owner[new], at[new], at[last] + DEPTH


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; an index takes whole blocks."""

    def answer(rows):
        table = pa.Table.from_batches(rows)
        doc, tie, start = (table.column(c).to_numpy() for c in ("doc", "tie", "start"))
        owner, first, stop = repeats_in([_bytes(b) for b in table.column("bytes")], doc, tie, start)
        columns = [pa.array(doc[owner]), pa.array(tie[owner]), pa.array(first), pa.array(stop)]
        return pa.RecordBatch.from_arrays(columns, names=["doc", "tie", "first", "stop"])

    held, size = [], 0
    for batch in batches:
        block = batch.column("block").to_numpy()
        borders = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else []
        lengths = np.concatenate(([0], np.cumsum([len(b.as_buffer()) for b in batch.column("bytes")])))
        at = 0
        for i in borders:
            if i > at:
                held.append(batch.slice(at, i - at))
                size, at = size + int(lengths[i] - lengths[at]), i
            if size >= INDEX_BYTES and (i > 0 or held[-1].column("block")[len(held[-1]) - 1].as_py() != block[0]):
                yield answer(held)
                held, size = [], 0
        if at < len(block):
            held.append(batch.slice(at))
            size += int(lengths[-1] - lengths[at])
    if held:
        yield answer(held)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges become maximal runs; what no run covers is left."""
    run = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        spans, left = [], []
        for t, ranges in zip(batch.column("t"), batch.column("ranges")):
            data, own = t.as_py(), []
            for r in sorted((r["first"], r["stop"]) for r in ranges.as_py() or []):
                if own and r[0] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], r[1])
                else:
                    own.append(list(r))
            stops = [0, *(b for _, b in own)]
            left.append(b"".join(data[a:b] for a, b in zip(stops, [*(a for a, _ in own), len(data)])))
            spans.append([{"start": a, "stop": b} for a, b in own])
        columns = [batch.column("doc"), batch.column("key"), pa.array([len(t.as_buffer()) for t in batch.column("t")], pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, run), pa.array(left, pa.binary())], names=["doc", "key", "n_bytes", "spans", "kept"])


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """doc, tie, first, stop: ranges of bytes of different ``texts`` (doc, tie, t) whose places all stand earlier too."""
    known = texts.mapInArrow(_count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    known = parked(known, "anchors")
    found = passing(texts.mapInArrow(_segment, _SEGMENT), "anchor", known.withColumnRenamed("anchor", "key"))
    found = parked(found.join(known, "anchor", "left_semi"), "segments", "zstd")
    same = ["anchor", "content", "length"]
    distinct = found.groupBy(*same).agg(F.min(F.struct("doc", "tie", "start")).alias("f"), F.max("several").alias("several"), F.count("*").alias("n"))
    distinct = parked(distinct, "distinct", "zstd")

    # all but the earliest of equal segments repeat whole
    copied = distinct.where("n > 1").select(*[F.col(c).alias(f"_{c}") for c in same], "f")
    equal = F.lit(True)
    for c in same:
        equal = equal & (F.col(c) == F.col(f"_{c}"))
    later = found.join(copied, equal).where(F.struct("doc", "tie", "start") != F.col("f"))
    later = later.select("doc", "tie", F.col("start").alias("first"), (F.col("start") + F.col("length")).alias("stop"))

    # different segments with one anchor may share places
    crowd = distinct.groupBy("anchor").agg(F.count("*").alias("variants"), F.max("several").alias("any")).where("variants > 1 or any")
    wanted = distinct.join(crowd.select("anchor", (F.col("variants") > CROWDED).alias("crowded")), "anchor")
    wanted = wanted.select("f.doc", "f.tie", F.struct(F.col("f.start").alias("start"), "length", "anchor", "crowded").alias("s"))
    wanted = wanted.groupBy("doc", "tie").agg(F.collect_list("s").alias("wanted"))  # of one text
    pieces = parked(texts.join(wanted, ["doc", "tie"]).mapInArrow(_cut, _PIECE), "pieces", "zstd")
    plain = pieces.where("not crowded").select("block", "doc", "tie", "start", "bytes")
    crowded = pieces.where("crowded").groupBy("block", "bytes").agg(F.min(F.struct("doc", "tie", "start")).alias("f"), F.count("*").alias("n"))
    crowded = parked(crowded, "crowded")
    more = pieces.where("crowded").join(crowded.where("n > 1").select(F.col("block").alias("_block"), F.col("bytes").alias("_bytes"), "f"), (F.col("block") == F.col("_block")) & (F.col("bytes") == F.col("_bytes")))
    more = more.where(F.struct("doc", "tie", "start") != F.col("f")).select("doc", "tie", F.col("start").alias("first"), (F.col("start") + F.length("bytes")).alias("stop"))
    blocks = plain.unionByName(crowded.select("block", "f.doc", "f.tie", "f.start", "bytes"))
    shared = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_index, "doc long, tie long, first long, stop long")
    return later.unionByName(more).unionByName(shared)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start, stop of the maximal removed runs), kept (the bytes left) of every row of ``docs`` (doc_id, text).

    A byte goes if it lies in DEPTH bytes that stand earlier too: in a document of smaller id or earlier in the same one. Null ids come
    last and equal ids in the order of their texts' hashes; rows that repeat id and text are one document and get the same result. Null
    is an empty text; texts of fewer bytes than DEPTH lose nothing; an empty table gives an empty result. ``doc_id`` is an integer.
    """
    kind = docs.schema["doc_id"].dataType
    rows = need(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), _text().alias("text"))
    rows = rows.withColumns({"key": F.md5("text"), "n_bytes": F.octet_length("text").cast("long")})
    narrow = parked(rows.select("doc", "key", "n_bytes"), "texts")
    firsts = parked(narrow.groupBy("key").agg(F.min("doc").alias("doc")), "firsts")
    # one row of every different text, at its least id
    texts = rows.join(firsts, ["key", "doc"]).dropDuplicates(["key", "doc"])
    texts = parked(texts.select("doc", "key", F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("t")), "first-texts", "zstd")
    ranges = repeated_ranges(texts.select("doc", "tie", "t"))
    ranges = ranges.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "stop")).alias("ranges"))  # of one text
    kept = texts.join(ranges, ["doc", "tie"], "left").select("doc", "key", "t", "ranges")
    kept = kept.mapInArrow(_kept, "doc long, key string, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    times = narrow.groupBy("doc", "key").agg(F.count("*").cast("int").alias("times")).where("times > 1")
    kept = kept.join(times, ["doc", "key"], "left").withColumn("_", F.explode(F.array_repeat(F.lit(0), F.coalesce("times", F.lit(1)))))
    first = firsts.select("key", F.col("doc").alias("first"))
    copies = narrow.join(first, "key").where("doc <> first")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    is_long = F.col("n_bytes") >= DEPTH
    short = rows.join(first, "key").where(~is_long & (F.col("doc") != F.col("first")))
    gone = copies.where(is_long).select("doc", "n_bytes", whole.alias("spans"), F.lit(b"").alias("kept"))
    short = short.select("doc", "n_bytes", F.expr("cast(array() as array<struct<start:long,stop:long>>)").alias("spans"), F.col("text").cast("binary").alias("kept"))
    out = kept.select("doc", "n_bytes", "spans", "kept").unionByName(gone).unionByName(short)
    return out.select(F.nullif("doc", F.lit(LAST)).cast(kind).alias("doc_id"), "n_bytes", "spans", "kept")
