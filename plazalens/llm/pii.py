"""Format-preserving pseudonyms of personal data by a keyed Feistel network, in SQL functions alone.

A value is read as a row of symbols, each with its own range: a digit, a letter, an octet, a part of a day number. The rounds add to
one half of the symbols a keyed hash of the other half, symbol by symbol within its range. So every format maps onto itself one to
one: an equal value gets an equal pseudonym in every document, and different values stay different.

Phones are seen with a country code, with a bracketed area code, as 555-123-4567 or 555.123.4567, and nationally with a leading 0 and
a blank, dash or slash after the area code. Unbroken digits alone are no phone. A date with slashes is read month first, and day first
where that isn't in the calendar; such a date stays one that can only be read day first. Letters of an e-mail's local part stay within
their alphabet (ALPHABETS; letters of other scripts stay as they are), and its domain goes into the key, so that one known short address
doesn't give away those of other domains. IPv6 addresses are seen in full and, from four digits on, shortened by a double colon.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import need
from plazalens.llm.decontam import let

ROUNDS = 8
# Shapes of the values, in order of preference, fixed values
SHAPES = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:[.][\p{L}\p{N}-]++)*(?<=[.]\p{L}{2,24})",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[.][0-9]{2}[.][0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}[.]){3}[0-9]{1,3}(?![0-9]|[.][0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:]|[.][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    # with country code, with brackets, plain north American with dashes or points, national with a trunk 0
    "phone": r"(?:\+1[ .-]?|(?<![0-9]))\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\+[2-9][0-9](?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![A-Za-z0-9.,-])(?:(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}[.][0-9]{3}[.][0-9]{4})(?![A-Za-z0-9]|[.-][0-9])"
    r"|(?<![A-Za-z0-9.,-])0[1-9][0-9]{1,4}[ /-](?:[0-9]{5,8}|[0-9]{3,4}[ -][0-9]{2,5}(?![ -][0-9]))(?![A-Za-z0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+",  # a whole row of digit groups, _cut() finds the cards in it
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
PATTERN = "|".join(SHAPES.values())
NO_CARD = "|".join(v for k, v in SHAPES.items() if k != "card")
CARD_GROUPS = "^(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})[ -]?$"
# First and last code points of rows of letters, fixed values: Latin, Greek, Cyrillic, Hebrew, Arabic, kana, ideographs, Hangul
ALPHABETS = (
    (0xC0, 0xD6), (0xD8, 0xDE), (0xDF, 0xF6), (0xF8, 0xFF), (0x100, 0x17F), (0x391, 0x3A1), (0x3A3, 0x3A9), (0x3B1, 0x3C9),
    (0x400, 0x40F), (0x410, 0x42F), (0x430, 0x44F), (0x450, 0x45F), (0x5D0, 0x5EA), (0x621, 0x63A), (0x641, 0x64A),
    (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
)
WALK = 64  # a permuted date is day first only with odds above one half: more steps are needed once in 10 ** 25 dates
FIRST_DAY, DAYS = "1900-01-01", (319, 229)  # 319 * 229 days end with 2099-12-31


def _ints(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def feistel(symbols: Column, ranges: Column, key: str, label: Column) -> Column:
    """``symbols`` (array of int, each within 0..range-1) permuted among all rows of symbols with these ranges."""

    def rounds(base):
        half = F.ceil(F.size(base) / F.lit(2)).cast("int")

        def one(state, r):
            left = r % 2 == 0  # the half that is changed
            other = F.when(left, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, F.lit(1), half))
            seed = F.concat_ws("|", F.lit(key), label, r.cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ","))

            def symbol(seed):
                def step(x, i):
                    drawn = F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 12), 16, 10).cast("long")
                    moved = ((x + drawn) % F.get(ranges, i)).cast("int")
                    return F.when((i < half) == left, moved).otherwise(x)

                return F.transform(state, step)

            return let(seed, symbol)

        return F.aggregate(_ints(range(ROUNDS)), base, one)

    return let(symbols, rounds)


def _chars(v: Column) -> Column:
    return F.split(v, "")


def _digits(v: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(v, "[^0-9]", "")), lambda c: c.cast("int"))


def _luhn_sum(digits: Column) -> Column:
    """Sum of Luhn's weighted digits, the last one counted once."""
    n = F.size(digits)

    def weighted(d, i):
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when((n - 1 - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(digits, weighted), F.lit(0), lambda a, x: a + x)


def _mod97(compact: Column) -> Column:
    """An IBAN's remainder, letters standing for 10 to 35."""

    def add(acc, c):
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, (acc * 10 + value) % 97).otherwise((acc * 100 + value) % 97)

    return F.aggregate(_chars(F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))), F.lit(0), add)


def _filled(v: Column, values: Column, kept: str = "[A-Za-z0-9]") -> Column:
    """``v`` with its letters and digits replaced by ``values`` in order; other characters stay."""

    def fill(values):  # bound, or every character would compute them again
        def put(acc, c):
            fits = c.rlike(kept)
            return F.struct(
                F.concat(acc["out"], F.when(fits, F.get(values, acc["at"])).otherwise(c)).alias("out"),
                (acc["at"] + F.when(fits, 1).otherwise(0)).alias("at"),
            )

        return F.aggregate(_chars(v), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), put, lambda acc: acc["out"])

    return let(values, fill)


def _alphabet(code: Column, of) -> Column:
    """``of(first, last)`` of the row of letters that a code point is in; of the code point alone where it is in none."""
    out = None
    for low, high in ALPHABETS:
        inside = code.between(low, high)
        out = F.when(inside, of(F.lit(low), F.lit(high))) if out is None else out.when(inside, of(F.lit(low), F.lit(high)))
    return out.otherwise(of(code, code))


def _char(code: Column) -> Column:
    """The character of a code point of the basic plane."""
    return F.when(code < 128, F.char(code)).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE"))


def _permuted_chars(plain: Column, fixed: Column | None, key: str, label: str | Column, first: Column | None = None, wide: bool = False) -> Column:
    """Letters and digits of ``plain`` permuted within their kind, as an array; the leading ``fixed`` ones stay, and places in
    ``first`` (array of int) keep to 2-9 or to 0 and 1, whichever their digit is of. ``wide``: letters of ALPHABETS are among them."""
    label = F.lit(label) if isinstance(label, str) else label
    code = lambda c: F.ascii(c)

    def low(c, i):
        start = F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97)
        start = start.when(code(c) > 127, _alphabet(code(c), lambda a, b: a)).otherwise(65) if wide else start.otherwise(65)
        return F.when(F.array_contains(first, i) & (c >= "2"), 50).otherwise(start) if first is not None else start

    def span(c, i):
        size = F.when(c.rlike("[0-9]"), 10)
        size = size.when(code(c) > 127, _alphabet(code(c), lambda a, b: b - a + 1)).otherwise(26) if wide else size.otherwise(26)
        size = F.when(F.array_contains(first, i), F.when(c >= "2", 8).otherwise(2)).otherwise(size) if first is not None else size
        return F.when(i < fixed, 1).otherwise(size) if fixed is not None else size

    def base(c, i):
        return F.when(i < fixed, code(c)).otherwise(low(c, i)) if fixed is not None else low(c, i)

    def build(chars):
        symbols, ranges = F.transform(chars, lambda c, i: code(c) - base(c, i)), F.transform(chars, span)
        shape = F.concat(label, F.array_join(F.transform(ranges, lambda x: x.cast("string")), "."))
        return let(feistel(symbols, ranges, key, shape), lambda moved: F.transform(chars, lambda c, i: (_char if wide else F.char)(F.get(moved, i) + base(c, i))))

    return let(_chars(plain), build)


def _email(v: Column, key: str) -> Column:
    local, domain = F.substring_index(v, "@", 1), F.substring_index(v, "@", -1)
    # letters beyond the basic plane stay as they are
    letter = r"[A-Za-z0-9\x{80}-\x{FFFF}&&[\p{L}\p{N}]]"
    moved = _permuted_chars(F.array_join(F.regexp_extract_all(local, F.lit(letter), F.lit(0)), ""), None, key, F.concat(F.lit("email:"), F.lower(domain), F.lit(":")), wide=True)
    return F.concat(_filled(local, moved, f"^{letter}$"), F.lit("@"), domain)


def _card(v: Column, key: str) -> Column:
    def check(body):
        total = _luhn_sum(F.concat(F.transform(body, lambda c: c.cast("int")), F.array(F.lit(0))))
        return _filled(v, F.concat(body, F.array(((10 - total % 10) % 10).cast("string"))))

    digits = F.regexp_replace(v, "[^0-9]", "")
    return let(_permuted_chars(F.substr(digits, F.lit(1), F.length(digits) - 1), F.lit(1), key, "card"), check)


def _iban(v: Column, key: str) -> Column:
    compact = F.replace(v, F.lit(" "), F.lit(""))

    def check(body):
        country = F.substring(compact, 1, 2)
        digits = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), F.array_join(body, "")))).cast("string"), 2, "0")
        return _filled(v, F.concat(_chars(country), _chars(digits), body))

    return let(_permuted_chars(F.substr(compact, F.lit(5)), None, key, "iban"), check)


def _phone(v: Column, key: str) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    code = v.startswith("+1") | v.startswith("1-")
    north = code | v.startswith("(") | v.rlike("^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$")
    fixed = F.when(code, 1).when(north, 0).otherwise(2)  # country code, or trunk 0 and the digit after it
    first = F.when(north, F.array(fixed, fixed + 3)).otherwise(F.array().cast("array<int>"))
    return _filled(v, _permuted_chars(digits, fixed, key, "phone", first))


def _parts(v: Column, shape: str, n: int) -> list[Column]:
    return [F.regexp_extract(v, shape, i + 1).cast("int") for i in range(n)]


def _ip(v: Column, key: str) -> Column:
    octets = F.transform(F.split(v, "[.]"), lambda x: x.cast("int"))
    return F.array_join(F.transform(feistel(octets, _ints([256] * 4), key, F.lit("ip")), lambda x: x.cast("string")), ".")


def _ip6(v: Column, key: str) -> Column:
    """Hexadecimal digits are permuted in their places; an address has one pseudonym in small and in capital letters."""
    digits = F.transform(_chars(F.replace(v, F.lit(":"), F.lit(""))), lambda c: F.conv(c, 16, 10).cast("int"))

    def build(digits):
        moved = feistel(digits, F.transform(digits, lambda d: F.lit(16)), key, F.concat(F.lit("ip6:"), F.regexp_replace(v, "[^:]", "x")))
        return F.transform(moved, lambda d: F.conv(d.cast("string"), 10, 16))

    out = _filled(v, let(digits, build))
    return F.when(v.rlike("[A-F]"), out).otherwise(F.lower(out))


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = _parts(v, "([0-9]+)-([0-9]+)-([0-9]+)", 3)
    symbols = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)

    def build(s):
        area = F.get(s, 0) + F.when(F.get(s, 0) >= 665, 2).otherwise(1)
        return F.format_string("%03d-%02d-%04d", area, F.get(s, 1) + 1, F.get(s, 2) + 1)

    return let(feistel(symbols, _ints([898, 99, 9999]), key, F.lit("ssn")), build)


def _day(v: Column) -> Column:
    shape = F.when(v.contains("-"), "yyyy-MM-dd").when(v.contains("."), "dd.MM.yyyy").when(_day_first(v), "dd/MM/yyyy").otherwise("MM/dd/yyyy")
    return F.to_date(F.try_to_timestamp(v, shape))


def _day_first(v: Column) -> Column:
    return v.rlike("^(?:1[3-9]|[23])[0-9]*/")


def _date(v: Column, key: str) -> Column:
    """Day numbers are permuted, so a date has one pseudonym whichever way it is written. A date with slashes, day first, is permuted until
    its day is above 12, which permutes the dates of that kind and keeps them apart from those that are month first."""
    number = F.datediff(_day(v), F.lit(FIRST_DAY).cast("date"))
    symbols = F.array(F.floor(number / DAYS[1]).cast("int"), number % DAYS[1])

    def day(s):
        return F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(s, 0) * DAYS[1] + F.get(s, 1))

    def moved(s):
        return feistel(s, _ints(DAYS), key, F.lit("date"))

    def build(s):
        ways = F.when(v.contains("-"), F.date_format(day(s), "yyyy-MM-dd")).when(v.contains("."), F.date_format(day(s), "dd.MM.yyyy"))
        return ways.when(_day_first(v), F.date_format(day(s), "dd/MM/yyyy")).otherwise(F.date_format(day(s), "MM/dd/yyyy"))

    def walked(s):
        step = lambda s, i: F.when((i > 0) & (~_day_first(v) | (F.dayofmonth(day(s)) > 12)), s).otherwise(moved(s))
        return F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), s, step)

    return let(walked(symbols), build)


def _valid_date(v: Column) -> Column:
    day = _day(v)
    return F.coalesce(day.between(F.lit(FIRST_DAY).cast("date"), F.date_add(F.lit(FIRST_DAY).cast("date"), DAYS[0] * DAYS[1] - 1)), F.lit(False))


def kind_of(v: Column) -> Column:
    """The kind of a matched value, null where it isn't a valid one: cards pass Luhn, IBANs modulo 97, dates are in the calendar
    between 1900 and 2099, IPv6 addresses have eight groups at most, octets without leading zeros end at 255, social security numbers avoid the unused areas."""
    whole = {k: f"^(?:{s})$" for k, s in SHAPES.items()}
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    ssn = "^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
    digits = _digits(v)
    return (
        F.when(v.contains("@"), F.lit("email"))
        .when(v.rlike(whole["date"]) & _valid_date(v), F.lit("date"))
        .when(v.rlike(f"^{octet}(?:[.]{octet}){{3}}$"), F.lit("ip"))
        .when(v.rlike(whole["ip6"]) & (F.size(F.split(v, ":")) <= 9), F.lit("ip6"))
        .when(v.rlike(ssn), F.lit("ssn"))
        .when(v.rlike(whole["phone"]), F.lit("phone"))
        .when(v.rlike("^[0-9 -]+$") & F.regexp_replace(v, "[^0-9]", "").rlike("^[0-9]{13,19}$") & let(digits, lambda d: _luhn_sum(d) % 10 == 0), F.lit("card"))
        .when(v.rlike("^[A-Z]{2}[0-9]{2}") & (_mod97(F.replace(v, F.lit(" "), F.lit(""))) == 1), F.lit("iban"))
    )


def pseudonym(kind: Column, v: Column, key: str) -> Column:
    """The pseudonym of value ``v``; null kinds leave it as it is."""
    ways = {"email": _email, "date": _date, "ip": _ip, "ip6": _ip6, "ssn": _ssn, "phone": _phone, "card": _card, "iban": _iban}
    out = None
    for name, way in ways.items():
        out = F.when(kind == name, way(v, key)) if out is None else out.when(kind == name, way(v, key))
    return out.otherwise(v)


def _pieces(v: Column, pattern: str, of_match) -> Column:
    """``v`` as an array of (v, hit): what lies between matches of ``pattern`` as it is, matches as the array ``of_match`` gives."""
    matches = F.regexp_extract_all(v, F.lit(pattern), 0)
    between = lambda g: F.array(_piece(g, False))
    whole = F.zip_with(F.split(v, pattern, -1), matches, lambda g, m: F.when(m.isNull(), between(g)).otherwise(F.concat(between(g), of_match(m))))
    return F.flatten(whole)


def _piece(v: Column, hit: bool) -> Column:
    return F.struct(v.alias("v"), F.lit(hit).alias("hit"))


def _cut(run: Column) -> Column:
    """Pieces of a row of digit groups: the valid cards in it, and the rest with matches of the other shapes.

    From left to right, a group begins a card if it and those after it are in one of CARD_GROUPS; otherwise if they make a card in any
    grouping that doesn't reach into such a card, the longest first.
    """

    def cut(groups):
        n = F.size(groups)
        text = lambda i, stop: F.array_join(F.slice(groups, i + 1, stop - i), "")

        def valid(i, stop):
            digits = F.regexp_replace(text(i, stop), "[^0-9]", "")
            return F.when(digits.rlike("^[0-9]{13,19}$"), let(_digits(digits), lambda d: _luhn_sum(d) % 10 == 0)).otherwise(False)

        def ends(i):
            stops = F.filter(F.sequence(i + 1, F.least(i + 19, n)), lambda stop: valid(i, stop))
            return let(stops, lambda x: F.struct(x.alias("any"), F.array_max(F.filter(x, lambda stop: text(i, stop).rlike(CARD_GROUPS))).alias("grouped")))

        def spans(ends):
            def longest(i):
                clear = lambda stop: ~F.exists(F.slice(ends, i + 2, stop - i - 1), lambda e: e["grouped"].isNotNull())
                return F.coalesce(F.get(ends, i)["grouped"], F.array_max(F.filter(F.get(ends, i)["any"], clear)))

            def step(acc, i):
                def put(stop):
                    taken = F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(F.struct(i.alias("start"), stop.alias("stop")))).alias("spans"))
                    return F.when(stop.isNull(), acc).otherwise(taken)

                return F.when(i < acc["at"], acc).otherwise(let(longest(i), put))

            none = F.array().cast("array<struct<start:int,stop:int>>")
            return F.aggregate(F.sequence(F.lit(0), n - 1), F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

        def pieces(spans):
            rest = lambda i, stop: F.when(stop > i, _pieces(text(i, stop), NO_CARD, lambda m: F.array(_piece(m, True)))).otherwise(F.array().cast(PIECES))

            def one(s, k):
                begin = F.when(k == 0, 0).otherwise(F.get(spans, k - 1)["stop"])
                card = text(s["start"], s["stop"])
                bare = F.regexp_replace(card, "[ -]$", "")
                return F.concat(rest(begin, s["start"]), F.array(_piece(bare, True), _piece(F.substr(card, F.length(bare) + 1), False)))

            last = F.when(F.size(spans) == 0, 0).otherwise(F.get(spans, F.size(spans) - 1)["stop"])
            return F.concat(F.flatten(F.transform(spans, one)), rest(last, n))

        return let(let(F.transform(F.sequence(F.lit(0), n - 1), ends), spans), pieces)

    return let(F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), 0), cut)


PIECES = "array<struct<v:string,hit:boolean>>"


def pseudonymised(docs: DataFrame, key: str, *keep: str) -> DataFrame:
    """``keep``, text with pseudonyms, and ``found`` (kinds of the replaced values in order) of every row of ``docs`` (text).

    A null text stays null, an empty one empty, both with nothing found; repeated rows repeat; an empty table gives an empty result.
    Only rows that may hold a value are matched at all; nothing is shuffled.
    """
    names = list(dict.fromkeys(keep))
    rows = need(docs, *dict.fromkeys([*names, "text"])).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], F.col("text").alias("t"))
    may = F.col("t").rlike("@|[0-9][^A-Za-z]{0,3}[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]")
    is_run = lambda m: m.rlike(f"^(?:{SHAPES['card']})$") & ~m.rlike(f"^(?:{SHAPES['phone']})$")
    pieces = _pieces(F.col("t"), PATTERN, lambda m: F.when(is_run(m), _cut(m)).otherwise(F.array(_piece(m, True))))
    pieces = F.when(may, pieces).otherwise(F.array().cast(PIECES))
    values = F.transform(pieces, lambda x: F.struct(x["v"].alias("v"), F.when(x["hit"], kind_of(x["v"])).alias("kind")))

    def done(values):
        text = F.array_join(F.transform(values, lambda x: pseudonym(x["kind"], x["v"], key)), "")
        found = F.filter(F.transform(values, lambda x: x["kind"]), lambda k: k.isNotNull())
        return F.when(F.size(values) > 0, F.struct(text.alias("text"), found.alias("found")))

    rows = rows.withColumn("done", let(values, done))
    return rows.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(names)],
        F.coalesce("done.text", "t").alias("text"),
        F.coalesce("done.found", F.array().cast("array<string>")).alias("found"),
    )
