"""Text normalisation as Catalyst expressions; no function here leaves the JVM unless its docstring says so."""

import html
import string
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from plazalens.functions.whitespace import PUNCTUATION, SPACE, WHITESPACE, char_class

# Hangul syllables decompose by arithmetic (Unicode standard, section 3.12).
_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3
_LEAD = "".join(map(chr, range(0x1100, 0x1113)))
_VOWEL = "".join(map(chr, range(0x1161, 0x1176)))
_TAIL = "".join(map(chr, range(0x11A8, 0x11C3)))


def _bare(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, str, dict[str, str]]:
    """(mapped from, mapped to, deleted, expanded) built from the Unicode database, Hangul left out."""
    src, dst, deleted, expanded = [], [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if _HANGUL_FIRST <= cp <= _HANGUL_LAST or 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        bare = _bare(ch)
        if bare == ch:
            continue
        if not bare:
            deleted.append(ch)
        elif len(bare) == 1:
            src.append(ch)
            dst.append(bare)
        else:
            expanded[ch] = bare
    return "".join(src), "".join(dst), "".join(deleted), expanded


def let(c: Column, body) -> Column:
    """``body(c)`` with ``c`` evaluated once, however often ``body`` uses it."""
    return F.transform(F.array(c), body)[0]


def computed_once(flag: Column) -> Column:
    """``flag`` unchanged, but opaque to predicate pushdown.

    A filter on a computed flag is pushed below the projection by copying the whole computation into the filter, which
    then runs twice or more. Catalyst leaves a column alone that reads the partition number, which is never negative.
    """
    return flag & (F.spark_partition_id() >= 0)


def _replace_all(c: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _split_hangul(c: Column) -> Column:
    def jamo(ch: Column) -> Column:
        at = F.ascii(ch) - F.lit(_HANGUL_FIRST)
        tail = at % 28
        return F.when(
            ch.between(chr(_HANGUL_FIRST), chr(_HANGUL_LAST)),
            F.concat(
                F.substring(F.lit(_LEAD), F.expr("1") + F.floor(at / 588).cast("int"), 1),
                F.substring(F.lit(_VOWEL), F.expr("1") + F.floor((at % 588) / 28).cast("int"), 1),
                F.when(tail > 0, F.substring(F.lit(_TAIL), tail, 1)).otherwise(""),
            ),
        ).otherwise(ch)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)), jamo), "")


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _fold(c: Column, also_deleted: str = "") -> Column:
    """Accents out, and the ASCII characters ``also_deleted``. ``c`` is used several times, see :func:`let`."""
    src, dst, deleted, expanded = _accent_tables()
    gone = src + deleted + also_deleted
    plain = F.regexp_replace(c, f"[{also_deleted}]+", "") if also_deleted else c
    rare = f"[\\x{{{_HANGUL_FIRST:x}}}-\\x{{{_HANGUL_LAST:x}}}{char_class(''.join(expanded))}]"
    return (
        F.when(_is_ascii(c), plain)
        # what decomposes to several characters lies far beyond the Latin blocks: one range test spares most rows
        .when(~c.rlike(r"[^\x00-\x{7FF}]") | ~c.rlike(rare), F.translate(c, gone, dst))
        .otherwise(F.translate(_replace_all(_split_hangul(c), expanded), gone, dst))
    )


def strip_accents(c: Column) -> Column:
    """Canonical decomposition without combining marks (``ñ`` -> ``n``)."""
    return let(c, lambda t: _fold(t))


def strip(c: Column) -> Column:
    """Trim every Unicode whitespace character at both ends, not only U+0020."""
    return F.btrim(c, F.lit(WHITESPACE))


# Java tests a class of Latin-1 characters with one bit lookup; the blanks beyond get a pass of their own, if present
_LATIN_BLANKS = char_class(PUNCTUATION + "".join(ch for ch in WHITESPACE if ord(ch) < 256))
_OTHER_BLANKS = char_class("".join(ch for ch in WHITESPACE if ord(ch) > 255))


def clean_text(c: Column) -> Column:
    """Lower case, handles out, punctuation and whitespace runs to one space, digits out, accents out, letter runs to one."""

    def drop_handles(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("@")), F.regexp_replace(t, f"@[^{SPACE}]+", "")).otherwise(t)

    def fold(t: Column) -> Column:
        return _fold(t, also_deleted=string.digits)

    def finish(t: Column) -> Column:
        other = F.regexp_replace(t, f"[ {_OTHER_BLANKS}]+", " ")
        wide = ~_is_ascii(t) & t.rlike(r"[^\x00-\x{7FF}]")
        return F.when(wide, let(F.btrim(other), fold)).otherwise(let(F.btrim(t), fold))

    blanked = F.regexp_replace(let(F.lower(c), drop_handles), f"[{_LATIN_BLANKS}]+", " ")
    return F.regexp_replace(let(blanked, finish), r"([a-z])\1+", "$1")


def unescape_xml(c: Column) -> Column:
    """The five XML entities; ``&amp;`` goes last so that nothing is unescaped twice."""
    return _replace_all(c, {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"})


def unescape_html(c: Column) -> Column:
    """Every HTML5 character reference. Only rows that hold an ``&`` carry text to the Arrow worker."""

    @F.pandas_udf("string")
    def unescape(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.coalesce(unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def _respace_handles(c: Column) -> Column:
    parts = F.filter(F.split(c, "@"), lambda e: e != "")
    joined = F.array_join(F.transform(parts, lambda e: F.concat(F.lit("@"), strip(e))), " ")
    return strip(F.when(F.startswith(c, F.lit("@")), joined).otherwise(F.substring(joined, 2, 2**31 - 1)))


def clean_model_text(c: Column, entities: str = "html5") -> Column:
    """Text as the classifier reads it: entities resolved, links to ``[URL]``, one line, a space before every ``@``.

    ``entities='xml'`` resolves only the entities the feed itself writes and stays in the JVM.
    """
    if entities not in ("html5", "xml"):
        raise ValueError("entities must be 'html5' or 'xml'")
    c = unescape_html(c) if entities == "html5" else unescape_xml(c)
    c = F.regexp_replace(c, f"http[^{SPACE}]+", "[URL]")
    return let(F.translate(c, "\n\t", "  "), _respace_handles)


def hashtags(c: Column) -> Column:
    """Every ``#`` run up to whitespace; repeats and trailing punctuation stay."""
    return F.regexp_extract_all(c, F.lit(f"#[^{SPACE}]+"), F.lit(0))
