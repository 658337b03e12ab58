"""The training-data operators against plain Python on small tables with nulls, empty texts, repeated rows and clashing names."""

import calendar
import hashlib
import itertools
import random
import re
from datetime import datetime

import pytest
import regex
from pyspark.sql import functions as F

from plazalens.llm import decontam, language, mixing, neardup, perplexity, pii, secrets, suffixdedup, urls, warc
from plazalens.llm.common import count_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, t string, id string"
WORDS = [a + b for a in ("ka", "mo", "ri", "su", "te", "lo", "wen", "dra") for b in ("nor", "vi", "sta", "pel", "gu", "zan")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    near = prose(1, 120).split()
    near[60] = "changed"
    passage = prose(99, 60)
    texts = [
        prose(1, 120), prose(1, 120), " ".join(near), prose(2, 80) + " " + passage, prose(3, 70) + " " + passage + " " + prose(4, 9),
        "", None, "   ", "short text", "ab" * 300, prose(5, 3000), "ÀÉ ñandú " + prose(6, 90), prose(7, 300) + "\n" + prose(7, 300),
    ]
    out = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    return [*out, out[3], (None, prose(1, 120), None, None, 0, None, None, None), (40, prose(8, 60), "en", "a", 0, "x", "y", "z")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def brute_repeats(rows):
    distinct = {(r[0], r[1] or "") for r in rows}
    seen, out = set(), {}
    for doc, text in sorted(distinct, key=lambda d: (d[0] is None, d[0])):
        data = text.encode()
        gone = [False] * len(data)
        for p in range(len(data) - 99):
            place = data[p : p + 100]
            if place in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(place)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowded", [1000, 0])
def test_suffix_dedup_is_brute_force(docs, rows, monkeypatch, crowded):
    monkeypatch.setattr(suffixdedup, "CROWDED", crowded)
    expected = brute_repeats(rows)
    found = suffixdedup.without_repeats(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        kept = bytes(r["kept"])
        removed = sum(s["stop"] - s["start"] for s in r["spans"])
        assert (r["n_bytes"], removed, hashlib.sha256(kept).hexdigest()) == expected[r["doc_id"]], r["doc_id"]


def test_suffix_dedup_of_nothing(nothing):
    assert suffixdedup.without_repeats(nothing).collect() == []


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(docs, rows, nothing):
    component = {i: i for i, _ in enumerate(rows)}
    sets = [shingles(r[1]) for r in rows]
    order = lambda i: (rows[i][0] is None, rows[i][0])
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    component[i] = component[j] = min(component[i], component[j], key=order)
    expected = [(r[0], len(sets[i]), rows[component[i]][0]) for i, r in enumerate(rows)]
    found = [(r["id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert neardup.near_duplicates(nothing).collect() == []


def test_decontamination(spark, docs, rows, nothing):
    bench = spark.createDataFrame([(1, prose(99, 60)), (2, "Short Text"), (3, None), (4, ""), (5, prose(77, 30))], "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = {}
    for item, text in bench.collect():
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    expected = []
    for r in rows:
        w, hit, items = words(r[1]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    items |= windows[tuple(w[i : i + n])]
        expected.append((r[0], len(w), len(hit), sorted(items)))
    found = [tuple(r) for r in decontam.decontaminate(docs, bench, "doc_id").collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert decontam.decontaminate(nothing, bench, "doc_id").collect() == []
    assert all(r["n_hit"] == 0 for r in decontam.decontaminate(docs, bench.limit(0), "doc_id").collect())


def test_quality_counts(docs, rows, nothing):
    expected = []
    for r in rows:
        text = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)} if len(w) < 700 else None
        lines = [x for x in text.split("\n") if x.strip(" \t\r\n\v\f")]
        expected.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), None if again is None else len(again)))
    found = perplexity.quality(docs, "doc_id").collect()
    own = {e[0]: e for e in expected}
    assert len(found) == len(rows)
    for r in found:
        e = own[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == e[1:5]
        if e[5] is not None and e[1] < 700:
            assert r["n_repeat_words"] == e[5]
        assert not (r["base_failed"] and r["kept"])
    assert perplexity.quality(nothing, "doc_id").collect() == []


def test_model_is_a_distribution(docs):
    model = perplexity.fit(docs)
    import numpy as np

    context = int(model.levels[-1][0].size and 5)
    ids = (np.int64(context) << perplexity.SYMBOL_BITS) + np.arange(perplexity.MASK + 1)
    for order in range(1, perplexity.ORDER + 1):
        assert abs(model.probability(order, ids).sum() - 1) < 1e-6


def test_language(spark, docs, nothing):
    texts = {"en": "the quick brown fox and the lazy dog went there with that ", "de": "der schnelle fuchs und die katze nicht mit einer "}
    table = [(i, texts[lang] * (1 + i % 3), lang) for i in range(60) for lang in ("en", "de")]
    labelled = spark.createDataFrame([*table, (500, None, "en"), (501, "12 34", "en"), (502, "the fox and that dog", None)], "doc_id long, text string, lang string")
    found = language.identify(labelled, language.fit(labelled), "text", "lang").collect()
    assert all(r["lang_pred"] == r["lang"] for r in found if r["lang"] and r["text"] and r["text"] != "12 34")
    assert {r["lang_pred"] for r in found if r["text"] in (None, "12 34")} == {"und"}
    assert [r["lang_pred"] for r in found if r["lang"] is None] == ["en"]
    assert {r["lang_pred"] for r in language.identify(docs, language.fit(nothing)).collect()} == {"und"}


def test_secrets(spark, nothing):
    token = "".join(random.Random(5).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=48))
    texts = ["password = hunter22 and é API-KEY", None, "", "x AKIA" + "A1" * 10 + " deadbeef" * 4, "note " + token + " end", prose(3, 400)]
    found = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id").collect()
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in found}
    assert spans[0] == [("assign", 0, 19)] and spans[1] == spans[2] == spans[5] == []
    assert ("access", 2, 26) in spans[3]
    assert spans[4] == [("random", 5, 53)]
    assert secrets.masked("abcdef", [(1, 3), (2, 4)], "*") == "a*ef"
    assert secrets.find_secrets(nothing, "doc_id").collect() == []


def test_mixing(docs, rows, nothing):
    found = mixing.mix(docs, count_words(F.col("text"))).collect()
    assert len(found) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in found:
        assert 0 <= r["repeats"] <= 3 and (r["size"] or not r["repeats"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["repeats"]
        target[r["source"]] = r["target"]
        longest = max(x["size"] for x in found if x["source"] == r["source"])
    for s in sizes:
        longest = max(x["size"] for x in found if x["source"] == s)
        assert target[s] <= 3 * sizes[s] + 1e-6 and abs(taken[s] - target[s]) <= longest
    again = mixing.mix(docs.repartition(2), count_words(F.col("text"))).collect()
    pick = lambda rs: sorted((str(r["doc_id"]), r["size"], r["repeats"]) for r in rs)
    assert pick(found) == pick(again)
    assert mixing.mix(nothing, count_words(F.col("text"))).collect() == []


def test_urls_and_warc_take_nulls(spark):
    pages = spark.createDataFrame([(1, "http://A.example.com/en/x", "<p>hi</p>"), (2, None, None), (3, "no scheme", ""), (1, "http://A.example.com/en/x", "<p>hi</p>")], "page_id long, url string, html string")
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/")]
    found = sorted((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in urls.filter_urls(pages, rules, pages.where("page_id = 9")).select("page_id", "host", F.coalesce("rule", F.lit("")).alias("rule"), "verdict").collect())
    assert found[0] == (1, "a.example.com", "example.com/en/", "block") and found[2:] == [(2, "", "", "allow"), (3, "", "", "allow")]
    assert warc.derivatives(warc.responses_of_pages(pages, "2024-06-01T00:00:00Z"), "page_id").count() == 8


def test_pseudonyms_link_equal_values(docs, rows):
    assert pii.pseudonymised(docs, "secret", "doc_id").count() == len(rows)


PERSONAL = {
    "email": ["ann.lee@mail.example.com", "José.Núñez@example.com", "юрий@пример.example", "王伟@example.cn"],
    "date": ["1987-03-14", "14.03.1987", "31/12/1987", "12/31/1986"],
    "ip": ["10.20.30.40"],
    "ip6": ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1ff:fe23:4567:890a", "2001:DB8::FF00:42"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (152) 555-8590", "+1 (017) 055-7713", "+1(826) 555-4081", "(902) 155-0101", "+1 052 555 1234", "555-123-4567", "155.023.4567", "1-555-123-4567", "0171 5554433", "030/1234567", "0171-555 4433", "+49 171 5554433"],
    "card": ["4111 1111 1111 1111", "378282246310005", "5500-0000-0000-0004"],
    "iban": ["DE89 3704 0044 0532 0130 00"],
}


def test_every_personal_value_is_replaced_and_linked(spark):
    values = [(k, v) for k, vs in PERSONAL.items() for v in vs]
    table = [(i, f"{before} {v}{after}") for i, (k, v) in enumerate(values) for before, after in (("called", " then"), ("é:", ", or"))]
    found = pii.pseudonymised(spark.createDataFrame(table, "doc_id int, text string"), "secret", "doc_id").collect()
    assert len(found) == len(table)
    pseudonyms = {}
    for r in found:
        kind, value = values[r["doc_id"]]
        assert r["found"] == [kind] and value not in r["text"], (value, r)
        new = r["text"].removeprefix("called ").removeprefix("é: ").removesuffix(" then").removesuffix(", or")
        assert regex.fullmatch(pii.SHAPES[kind], new), (value, new)
        pseudonyms.setdefault(value, set()).add(new)
    assert all(len(p) == 1 for p in pseudonyms.values())
    assert len(set().union(*pseudonyms.values())) == len(values)
    areas = pii.pseudonymised(spark.createDataFrame([(f"+1 ({a:03d}) 055-7713",) for a in range(1000)], "text string"), "secret").collect()
    assert len({r["text"] for r in areas}) == 1000 and all(r["found"] == ["phone"] for r in areas)


def test_a_common_passage_fills_no_bucket_with_pairs(spark):
    def member(k, own, total=100):
        return ("b", "c0", f"c{k}", f"c{k}", total, total - own)

    schema = "bucket string, major string, class string, component string, n long, shared long"

    def sides(rows):
        df = spark.createDataFrame(rows, schema).withColumn("parity", F.array(F.lit(0).cast("long")))
        minor, every = neardup._sides(df)
        return minor.join(every, ["bucket", "level"])

    # 64 and 80 of 100 shingles in common with others: not linked with each other, so no pair of 500 of them meets
    assert sides([member(k, 36) for k in range(500)]).count() == 0
    assert sides([member(k, 20) for k in range(500)]).count() == 0
    # every pair that sizes and shares allow still meets
    r = random.Random(5)
    rows = [("b", "c0", f"c{k}", f"c{k}", n := r.choice([1, 2, 3, 4, 7, 40, 52, 53, 54, 70, 71, 72, 100, 110, 121, 10**6]), r.randint(n * 7 // 10, n)) for k in range(300)]
    met = {(x["class_a"], x["class_b"]) for x in sides(rows).select("class_a", "class_b").collect()}
    for _, _, a, _, na, sa in rows[1:]:
        for _, _, b, _, nb, sb in rows:
            if 175 * min(sa, sb) >= 75 * (na + nb) and 100 * min(na, nb) >= 75 * max(na, nb):
                assert (a, b) in met, (na, sa, nb, sb)


def test_pseudonyms_of_a_kind_stay_apart(spark):
    def given(texts):
        rows = pii.pseudonymised(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), "secret", "i").collect()
        return [r["text"] for r in sorted(rows, key=lambda r: r["i"])]

    days = [f"{d:02}/{m:02}/{y}" for y in (1987, 1988) for m in range(1, 13) for d in range(1, calendar.monthrange(y, m)[1] + 1)]
    new = given(days)
    assert len(set(new)) == len(days)
    for old, n in zip(days, new):
        assert (int(old[:2]) > 12) == (int(n[:2]) > 12) and datetime.strptime(n, "%d/%m/%Y" if int(n[:2]) > 12 else "%m/%d/%Y")
    locals_ = ["".join(x) for x in itertools.product("aéñяZ7", repeat=2)] + list("aéñяZ7")
    mails = given([f"{x}@b.example" for x in locals_])
    assert len(set(mails)) == len(mails)
    letters = {x: given([f"{x}@{d}.example" for d in ("b", "c", "d", "e", "f", "g")]) for x in "ab"}
    # one known pair doesn't tell the shift of another domain
    assert len({(ord(t[0]) - ord(x)) % 26 for x, ts in letters.items() for t in ts}) > 2
    assert given(["ABCD::1"])[0].lower() == given(["abcd::1"])[0] and given(["12:30:45 a::b std::cout 31/13/1987"])[0] == "12:30:45 a::b std::cout 31/13/1987"


def test_cards_beside_other_numbers(spark):
    card, other = "4111 1111 1111 1111", "5500 0000 0000 0004"
    texts = [
        f"order 12 {card}", "853 4111111111111111", f"{card} 12", f"1234 {card}", f"12 34 56 78 90 {card} 7", f"{card} {other}",
        "12 3782 822463 10005", f"{card} 123-45-6789", f"12 0171 5554433 {card}", "7 41 1111 11111111 1111", "1 " * 20000 + card,
    ]
    found = {r["i"]: r for r in pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "secret", "i").collect()}
    for i, t in enumerate(texts):
        for v in (card, other, "4111111111111111", "3782 822463 10005", "123-45-6789", "0171 5554433", "41 1111 11111111 1111"):
            assert v not in t or v not in found[i]["text"], (t[-60:], found[i]["text"][-60:])
        assert [len(x) for x in found[i]["text"].split(" ")] == [len(x) for x in t.split(" ")]
    kinds = [r["found"] for _, r in sorted(found.items())]
    assert kinds[:5] == [["card"]] * 5 and kinds[5:10] == [["card", "card"], ["card"], ["card", "ssn"], ["phone", "card"], ["card"]]
    new = {found[0]["text"][9:], found[2]["text"][:19], found[3]["text"][5:], found[5]["text"][:19], found[7]["text"][:19]}
    assert len(new) == 1


def test_junk_is_dropped_however_often_it_is_copied(spark):
    def junk(seed):
        r = random.Random(seed)
        return " ".join("".join(r.choices("qxzjkvwpfgbcdhlmn", k=r.randint(2, 9))) for _ in range(150))

    table = [(i, prose(1000 + i, 150), "en") for i in range(200)]
    hot = [(1000 + i, junk(1), "en") for i in range(120)]
    table += [*hot, *[(2000 + i, junk(10 + i), "en") for i in range(6)]]
    found = perplexity.quality(spark.createDataFrame(table, "doc_id int, text string, lang string").repartition(4), "doc_id").collect()
    assert not any(r["base_failed"] for r in found)
    assert not any(r["kept"] for r in found if r["doc_id"] >= 1000)
    assert sum(r["kept"] for r in found if r["doc_id"] < 1000) >= 196


def test_benchmark_items_without_id_contaminate(spark):
    bench = spark.createDataFrame([(None, prose(99, 30)), (None, "lone words"), (5, prose(77, 30))], "item_id long, text string")
    texts = [prose(3, 20) + " " + prose(99, 30), "the lone words here", prose(77, 12) + " " + prose(99, 30), prose(4, 40), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontam.decontaminate(docs, bench, "doc_id").collect()}
    assert found == {0: (30, []), 1: (2, []), 2: (42, ["5"]), 3: (0, []), 4: (0, [])}


def test_false_discovery_counts_tokens_once(spark):
    name = "getElementsByClassName"
    # ordinary tokens of its length class, so 'name' is no discovery however often it occurs
    others = ["".join(random.Random(i).choices(WORDS, k=8))[:24] for i in range(100)]
    texts = [*[f"call {name} now"] * 200, *others]
    found = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "doc_id").collect()
    assert 6 < secrets.suspicion(name) < 10 and all(r["spans"] == [] for r in found)


def test_a_discovery_shows_among_millions(spark):
    token = lambda n, score, h: F.array(F.struct(F.lit(secrets._bin(n, score)).cast("int").alias("bin"), h.alias("hash")))
    ordinary = spark.range(4_000_000).select(token(48, 0.6, F.col("id")).alias("tokens"))
    scanned = ordinary.unionByName(spark.range(1).select(token(48, 100.0, F.lit(-1).cast("long")).alias("tokens")))
    least = secrets.thresholds(scanned)[secrets.length_class(48)]
    assert 2 < least <= secrets._bin(48, 100.0) % secrets.BINS


def test_costs_are_those_of_plain_counts(spark, monkeypatch):
    """Strings of ORDER bytes, none folded; one occurrence left out; ranges and small tables change nothing."""
    import math
    from collections import Counter, defaultdict

    order = perplexity.ORDER
    texts = [prose(1, 60), prose(2, 60), "Name 12 name 13 $$$ " + prose(3, 55), "ÀÉ ñandú 7,5 " + prose(1, 50), "###", "a", ""]
    levels = [Counter()]
    for t in texts:
        data = b" " * (order - 1) + t.encode()
        levels[0].update(data[i : i + order] for i in range(len(data) - order + 1))
    for _ in range(order - 1):
        levels.insert(0, Counter(g[1:] for g in levels[0]))

    def discounted(level):
        n = [sum(v == k for v in level.values()) for k in (1, 2, 3, 4)]
        off = perplexity._discounts(n)
        return lambda k: off[min(k, 3) - 1] if k else 0.0

    p, out = {b"": 1 / 256}, {b"": 1 / 256}
    for level in levels:
        off, total, mass = discounted(level), defaultdict(int), defaultdict(float)
        for g, n in level.items():
            total[g[:-1]] += n
            mass[g[:-1]] += off(n)
        for g, n in level.items():
            c = g[:-1]
            p[g] = (n - off(n) + mass[c] * p[g[1:]]) / total[c]
            rest = out[g[1:]] if n == 1 else p[g[1:]]
            out[g] = rest if total[c] == 1 else (n - 1 - off(n - 1) + (mass[c] - off(n) + off(n - 1)) * rest) / (total[c] - 1)
    expected = {}
    for i, t in enumerate(texts):
        data = b" " * (order - 1) + t.encode()
        content = sum(b not in b" \t\n\v\f\r#*$%&|<>" for b in t.encode())
        cost = sum(-math.log(out[data[j : j + order]]) for j in range(len(t.encode())))
        expected[i] = cost / content if content else None
    docs = spark.createDataFrame([*enumerate(texts), (7, None), *((8 + i, texts[0]) for i in range(3))], "doc_id int, text string").withColumn("lang", F.lit("en"))
    for held, part in ((perplexity.HELD_GRAMS, perplexity.RANGE_GRAMS), (100, 200)):
        monkeypatch.setattr(perplexity, "HELD_GRAMS", held)
        monkeypatch.setattr(perplexity, "RANGE_GRAMS", part)
        found = {r["doc_id"]: r["log_perplexity"] for r in perplexity.quality(docs.repartition(3), "doc_id").collect()}
        for i in range(11):
            e = expected.get(i) if i < 8 else expected[0]
            assert found[i] == (None if e is None else pytest.approx(e, rel=1e-5)), (i, held)


def test_marks_between_words_are_junk_and_letters_are_not_folded(spark):
    good = [(i, prose(3000 + i, 120), "en") for i in range(150)]
    marked = [(1000 + i, " ".join(w + random.Random(i * 999 + j).choice(["$$$", "###", "%%%", " |"]) for j, w in enumerate(prose(5000 + i, 120).split())), "en") for i in range(6)]
    # letters in the case that they never have; a model that folds case can't tell
    upper = [(2000, prose(6000, 120).swapcase(), "en")]
    found = perplexity.quality(spark.createDataFrame([*good, *marked, *upper], "doc_id int, text string, lang string").repartition(4), "doc_id").collect()
    assert not any(r["base_failed"] for r in found)
    assert not any(r["kept"] for r in found if r["doc_id"] >= 1000)
    assert sum(r["kept"] for r in found if r["doc_id"] < 1000) >= 148
