"""The Merkle manifest, phrase collocations and shards against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plazalens.llm import collocations, merkle, ranks, sharding

DOCS = "doc_id long, source string, lang string, n_chars long, text string, size long, tree string, idx long, shard int, a long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TAMPERED = lambda: F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def frame(spark, rows):
    """Rows of five fields, with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 7, "t", 7, 7, 7) for r in rows], DOCS).repartition(3)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    members = {x: sorted(groups[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for x in order}
    trees = {x: levels_of([leaf_of(r) for r in members[x]]) for x in order}
    top = levels_of([trees[x][-1][0] for x in order])
    out = []
    for k, x in enumerate(order):
        for i, r in enumerate(members[x]):
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded, proof = leaf_of(r[:4] + (r[4].translate(LOWER),)) if hit else leaf_of(r), []
            for levels, j in ((trees[x], i), (top, k)):
                for level in levels[:-1]:
                    run, at = level[j // 8 * 8 :][:8], j % 8
                    proof += run[:at] + run[at + 1 :]
                    folded = sha(*run[:at], folded, *run[at + 1 :])
                    j //= 8
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[x][-1][0], root, sha(*proof), folded, folded == root))
    return out


MANY = [(i if i % 17 else None, "s", ["en", "de", None, "fr", ""][min(i % 11, 4)], i, "AbÉ " * (i % 9)) for i in range(620)]


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "s", "en", 3, "AbC")],
        [(1, "s", "en", 3, "AbC"), (2, None, "en", None, ""), (3, None, None, None, None)],
        [*MANY, *[(5, "s", "en", 5, "copy")] * 70, (7, "s", "xx", 1, "Long " * 200_000)],
        [(i, "s", f"l{i}", 1, "T") for i in range(20)],
    ],
)
def test_manifest_is_brute_force(spark, rows):
    found = [tuple(r) for r in merkle.manifest(frame(spark, rows), TAMPERED()).collect()]
    assert sorted(found, key=str) == sorted(brute_manifest(rows), key=str)


def test_manifest_climbs_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", -1)
    found = [tuple(r) for r in merkle.manifest(frame(spark, MANY), TAMPERED()).collect()]
    assert sorted(found, key=str) == sorted(brute_manifest(MANY), key=str)


def test_manifest_of_nothing(spark):
    found = merkle.manifest(frame(spark, []), TAMPERED())
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and found.isEmpty()


def test_bound_on_recursion_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(frame(spark, MANY[:40]), TAMPERED()).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_numbered(spark):
    rows = [("a", i % 50, 1) for i in range(400)] + [(None, 3, 1), (None, None, 2), ("b", 1, 1)]
    found = ranks.numbered(spark.createDataFrame(rows, "g string, k long, n1 long").repartition(5), "g", "k").collect()
    for g in ("a", "b", None):
        own = sorted((r["idx"], (-1 if r["k"] is None else r["k"]), r["n"]) for r in found if r["g"] == g)
        want = sorted(-1 if r[1] is None else r[1] for r in rows if r[0] == g)
        assert own == [(i, k, len(want)) for i, k in enumerate(want)]


# ---------------------------------------------------------------- phrases


def brute_phrases(rows, least, top):
    grams, totals = defaultdict(Counter), Counter()
    for _, _, lang, _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    grams[lang or "und"][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in grams.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i : i + m]] = max(most[p[i : i + m]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * most[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s))
    return out


def phrase_rows():
    r = random.Random(5)
    words = [f"w{i}" for i in range(25)] + ["É", "naïve", "B-52"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(r.randint(0, 60)):
            text += r.choices(words, weights)[0] + r.choice([" ", "  ", "\t", " ", ". ", ",", "\n", " "])
        rows.append((i, "s", ["en", "de", None, "und"][i % 4], 1, text + "New York City Hall " * (i % 5)))
    return [*rows, rows[3], rows[3], (None, None, "en", None, None), (200, "s", "xx", 0, ""), (201, "s", "en", 0, "the w1 w2 " * 30_000)]


@pytest.mark.parametrize("least, top, slack", [(3, 2000, 2), (2, 5, 1), (5, 12, 1)])
def test_phrases_are_brute_force(spark, monkeypatch, least, top, slack):
    """The short lists need several thresholds; equal scores come by count and phrase."""
    for name, value in (("LEAST", least), ("TOP", top), ("SLACK", slack), ("STEP", 2), ("PENDING", 50), ("CHUNK", 1000), ("SPREAD", 3)):
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows()
    found = [tuple(r) for r in collocations.collocations(frame(spark, rows)).collect()]
    assert sorted(found) == sorted(brute_phrases(rows, least, top))


def test_full_filters_lose_nothing(spark, monkeypatch):
    """A filter of a few bits lets everything through; counts stay right."""
    monkeypatch.setattr(collocations, "LEAST", 4)
    full = collocations.Filter(np.full(1024, -1, np.int64).view(np.uint64))
    monkeypatch.setattr(collocations, "built", lambda grams, columns: full)
    rows = phrase_rows()[:60]
    found = [tuple(r) for r in collocations.collocations(frame(spark, rows)).collect()]
    assert sorted(found) == sorted(brute_phrases(rows, 4, 2000))


def test_grams_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(collocations, "gram_hash", lambda columns: np.zeros(len(columns[0]), np.uint64))
    columns = [np.array([1, 2, 1, 2], np.uint64), np.array([3, 4, 3, 5], np.uint64)]
    (a, b), counts, _ = collocations.summed(columns, np.ones(4, np.int64))
    assert sorted(zip(a.tolist(), b.tolist(), counts.tolist())) == [(1, 3, 2), (2, 4, 1), (2, 5, 1)]


def test_words_of_one_hash_are_hashed_anew(spark, monkeypatch):
    plain = collocations._count_words

    def count_words(seed):
        counted = plain(seed)

        def count(batches):
            for batch in counted(batches):
                # under the first seed all words have one hash
                yield batch if seed else batch.set_column(0, "h", pa.array([1] * len(batch), pa.int64()))

        return count

    monkeypatch.setattr(collocations, "_count_words", count_words)
    docs = frame(spark, [(1, "s", "aa", 1, "x y"), (2, "s", "bb", 1, "x z")])
    words, seed = collocations.word_counts(docs.select("lang", "text"))
    assert seed == 1 and sorted((r["lang"], r["word"], r["f"]) for r in words.collect()) == [
        ("aa", "x", 1), ("aa", "y", 1), ("bb", "x", 1), ("bb", "z", 1),
    ]


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 1, None), (2, "s", None, 1, " ,. ")], [(1, "s", "en", 1, "a b c")]])
def test_no_phrases(spark, rows):
    found = collocations.collocations(frame(spark, rows))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.isEmpty()


# ---------------------------------------------------------------- shards


def shard_rows(copies=150):
    r = random.Random(3)
    rows = [(i, "s", "en", 1, "x" * int(r.paretovariate(1.1) * 20)) for i in range(400)]
    rows += [(1000 + i, "s", "en", 1, "one text of many copies é") for i in range(copies)]
    return [*rows, *[(7, "s", None, None, "the same row")] * 40, (None, "s", "en", 1, None), (None, "s", "en", 1, ""), (5000, "s", "en", 1, None)]


def hash60(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("n_shards, range_rows", [(8, 1 << 20), (8, 4), (3, 25), (1, 10)])
def test_shards(spark, monkeypatch, n_shards, range_rows):
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    rows = shard_rows()
    found = sharding.shards(frame(spark, rows), n_shards, "text").collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r["doc_id"], r["text"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], r[4], size(r[4]), zlib.crc32((r[4] or "").encode())) for r in rows
    )
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(n_shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(size(r[4]) for r in rows)
    mean = sum(sizes.values()) / n_shards
    assert all(abs(s - mean) <= max(largest, mean / sharding.GROUP_SHARE) for s in sizes.values())
    # the order is that of the hashes, over shards and slots
    keys = [(-1 if r["text"] is None else hash60(r["text"]), hash60("-" if r["doc_id"] is None else f"={r['doc_id']}"))
            for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert keys == sorted(keys)


def test_ranges_do_not_decide(spark, monkeypatch):
    docs = frame(spark, shard_rows())
    key = lambda r: (str(r["doc_id"]), r["size"], r["shard"], r["slot"])
    first = sorted(map(key, sharding.shards(docs).collect()))
    monkeypatch.setattr(sharding, "RANGE_ROWS", 7)
    monkeypatch.setattr(sharding, "DRAWS", 3)
    assert sorted(map(key, sharding.shards(docs.repartition(2)).collect())) == first


def test_overfull_ranges_are_cut(spark, monkeypatch):
    """A third of the rows in copies of one text, and repeated rows, don't meet in one range."""
    rows = frame(spark, [(1000 + i, "s", "en", 1, "copy") for i in range(600)] + shard_rows(0)[:443] + [(7, "s", "en", 1, "row")] * 300)
    seen = {}
    plain = sharding._placed

    def placed(rows, held):
        seen.update(held)
        return plain(rows, held)

    monkeypatch.setattr(sharding, "_placed", placed)
    monkeypatch.setattr(sharding, "RANGE_ROWS", 30)
    assert sharding.shards(rows).count() == 1343
    assert max(c for _, c in seen.values()) < 200


def test_copies_stay_together_and_hot_ones_are_split(spark):
    texts = [f"text {i} " + "y" * 300 for i in range(300)]
    rows = [(i, "s", "en", 1, texts[i // 2]) for i in range(600)] + [(900 + i, "s", "en", 1, "hot " * 60) for i in range(300)]
    found = sharding.shards(frame(spark, rows), 8, "text").collect()
    where = defaultdict(set)
    for r in found:
        where[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith("hot"))
    assert len(where["hot " * 60]) > 1


def test_no_shards(spark):
    found = sharding.shards(frame(spark, []))
    assert found.isEmpty() and found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_written_shards(spark, tmp_path):
    docs = frame(spark, shard_rows()).drop("shard")
    sharding.write_shards(docs, f"{tmp_path}/shards", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.columns == [*docs.columns, "shard"] and back.select("shard").distinct().count() == 4
    assert Counter(map(str, back.drop("shard").collect())) == Counter(map(str, docs.collect()))
