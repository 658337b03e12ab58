"""Character sets shared by the text functions.

Java's ``\\s`` covers ASCII only and ``(?U)\\s`` still misses U+001C..U+001F, so the text rules spell the
whitespace set out. The set is derived from ``str.isspace`` instead of being typed in.
"""

import string
import sys

WHITESPACE = "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())


def char_class(chars: str) -> str:
    """Body of a Java character class that contains exactly ``chars`` (no brackets, no negation).

    Latin-1 characters stay single, which Java keeps in one bit set; the others are folded into ranges.
    """
    points = sorted(map(ord, chars))
    body = "".join(f"\\x{{{cp:x}}}" for cp in points if cp < 256)
    start = None
    for cp, following in zip(points, [*points[1:], None]):
        if cp < 256:
            continue
        start = cp if start is None else start
        if following != cp + 1:
            body += f"\\x{{{start:x}}}" + (f"-\\x{{{cp:x}}}" if cp > start else "")
            start = None
    return body


SPACE = char_class(WHITESPACE)
PUNCTUATION = string.punctuation
