"""Handle replacement: known handles become their group token, the others one common token."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from plazalens.functions.text import let
from plazalens.functions.whitespace import SPACE, char_class

OTHER_TOKEN = "USER"

# What may stand next to a handle, besides whitespace and the ends of the text
EDGE = SPACE + char_class(".,;:!?()-=[]")
_TO_END = 2**31 - 1


def _pieces(c: Column) -> Column:
    """The text cut in front of every ``@``: (text, handle). ``handle`` is null unless edges enclose it.

    Work grows with the number of ``@`` signs, not with the length of the text.
    """

    def cut(parts: Column) -> Column:
        def piece(part: Column, at: Column) -> Column:
            run = F.regexp_extract(part, f"^[^{EDGE}]+", 0)
            before = F.get(parts, at - 1)
            opens = F.when(before == "", at == 1).otherwise(F.substring(before, -1, 1).rlike(f"[{EDGE}]"))
            closes = (run != part) | (at == F.size(parts) - 1)
            return F.struct(
                F.when(at > 0, F.concat(F.lit("@"), part)).otherwise(part).alias("text"),
                F.when((at > 0) & (run != "") & opens & closes, run).alias("handle"),
            )

        return F.transform(parts, lambda part, at: piece(part, at))

    return let(F.split(c, "@"), cut)


def handle_candidates(c: Column) -> Column:
    """Lower-cased handles that stand between edges: the ones a group lookup can hit."""
    found = F.transform(_pieces(c), lambda p: F.lower(p["handle"]))
    return F.array_distinct(F.filter(found, lambda h: h.isNotNull()))


class HandleGroups:
    """Ordered ``{token: [handle, ...]}`` of a seed list that fits in a plan."""

    def __init__(self, groups: dict[str, list[str]]):
        self.tokens = list(groups)
        self._members: dict[str, list[str]] = {}
        taken: set[str] = set()
        for token, handles in groups.items():
            mine = dict.fromkeys(h.lower() for h in handles if h)
            self._members[token] = [h for h in mine if h not in taken]
            taken.update(mine)

    def token_of(self, handle: Column) -> Column:
        """Token of a lower-cased handle; long lists become one hash-set test per token."""
        out = F.lit(None).cast("string")
        for token in reversed(self.tokens):
            members = self._members[token]
            if members:
                out = F.when(handle.isin(members), F.lit(token)).otherwise(out)
        return out


def _swap(c: Column, token_of) -> Column:
    def swap(p: Column) -> Column:
        rest = F.substring(p["text"], F.char_length(p["handle"]) + 2, F.lit(_TO_END))
        return F.coalesce(F.concat(token_of(F.lower(p["handle"])), rest), p["text"])

    return F.array_join(F.transform(_pieces(c), swap), "")


def swap_handles(c: Column, token_of) -> Column:
    """Text with known handles replaced by their token and the others by the common one, without ``@``."""
    return F.regexp_replace(_swap(c, token_of), f"@[^{SPACE}]+", OTHER_TOKEN)


def mark_tokens(c: Column, tokens: Column) -> Column:
    """``@`` put in front of every occurrence of a token, one token of the array after the other, the common one last."""
    every = F.concat(tokens, F.array(F.lit(OTHER_TOKEN)))
    return F.aggregate(every, c, lambda text, token: F.replace(text, token, F.concat(F.lit("@"), token)))


def replace_handles(c: Column, tokens: list[str], token_of) -> Column:
    """Text with handles replaced; ``token_of`` maps a lower-cased handle column to its token or null.

    The last step puts the ``@`` back in front of every occurrence of a token, ordinary words included.
    """
    out = swap_handles(c, token_of)
    for token in [*tokens, OTHER_TOKEN]:
        out = F.replace(out, F.lit(token), F.lit("@" + token))
    return out


def matched_handles(c: Column, tokens: list[str], token_of) -> Column:
    """Struct of the handles each token replaced, in text order, and under ``USER`` whatever was left."""
    enclosed = F.filter(_pieces(c), lambda p: p["handle"].isNotNull())

    def of(token: str) -> Column:
        mine = F.filter(enclosed, lambda p: token_of(F.lower(p["handle"])) == F.lit(token))
        return F.transform(mine, lambda p: F.concat(F.lit("@"), p["handle"]))

    rest = F.regexp_extract_all(_swap(c, token_of), F.lit(f"@[^{SPACE}]+"), F.lit(0))
    return F.struct(*[of(t).alias(t) for t in tokens], rest.alias(OTHER_TOKEN))
