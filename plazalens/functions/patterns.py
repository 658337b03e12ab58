"""Helpers for dictionary patterns, which are written in Python syntax and run by ``java.util.regex``."""

import re

# (?U) Unicode classes, (?d) only \n ends a line: the defaults of Python's str patterns
_FLAGS = "(?Ud)"
_ESCAPE_OR_CLASS = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\(\?P<|\(\?P=(\w+)\)", re.S)
_CLASS_ITEM = re.compile(r"\\.|\[|&&", re.S)
_RESPELLED = {r"\Z": r"\z", "(?P<": "(?<", "[": r"\[", "&&": r"&\&"}
# Constructs whose outcome depends on what stands before the searched position
_START_SENSITIVE = re.compile(r"\\[bBA]|\^|\(\?<[=!]")
_FUZZY = re.compile(r"\{[^}]*(?:<|\b[eids]\b)[^}]*\}")


def java_pattern(pattern: str, ignore_case: bool = False) -> str:
    """The same pattern in Java syntax: named groups, ``\\Z``, and ``[`` or ``&&`` inside a class are respelled."""

    def respell(m: re.Match) -> str:
        piece = m.group(0)
        if m.group(1):
            return rf"\k<{m.group(1)}>"
        if piece[0] == "[":
            head = re.match(r"\[\^?\]?", piece).group(0)
            body = _CLASS_ITEM.sub(lambda i: _RESPELLED.get(i.group(0), i.group(0)), piece[len(head):])
            return head.replace("]", r"\]") + body
        return _RESPELLED.get(piece, piece)

    return ("(?iu)" if ignore_case else "") + _FLAGS + _ESCAPE_OR_CLASS.sub(respell, pattern)


def start_sensitive(pattern: str) -> bool:
    """True when cutting the text in front of a later hit may change that hit."""
    return bool(_START_SENSITIVE.search(pattern.replace("[^", "[")))


# Pieces of a pattern: comments and group heads first, then escapes, classes, quantifiers, single characters
_PIECE = re.compile(
    r"\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{3}|.)|\[\^?\]?(?:\\.|[^\]\\])*\]|\(\?P=\w+\)|\(\?P<\w+>|\(\?<[=!]|\(\?[:=!>]|\(\?|\("
    r"|[*+?][+?]?|\{\d*,?\d*\}[+?]?|.",
    re.S,
)
# What stands at the end of the last hit, where the rest of the text begins
_AT_CUT = {r"\b": r"(?:\G(?=\w)|(?!\G)\b)", r"\B": r"(?:\G(?!\w)|(?!\G)\B)", "^": r"\G", r"\A": r"\G"}


def cut_pattern(pattern: str) -> str | None:
    r"""``pattern`` such that one scan finds what searching the text left after each hit would; None where that can't be written.

    In a scan ``\G`` is the end of the last hit. Anchors and edges take it for the start of the text, and a look-behind may not reach
    across it: each character it takes must not end there. None for inline flags, comments, conditions, back references in a look-behind,
    patterns that Python refuses, and those that may match nothing (after an empty match ``\G`` lags behind).
    """
    try:
        re.compile(pattern)
        if re._parser.parse(pattern).getwidth()[0] == 0:
            return None
    except re.error:
        return None
    out: list[str] = []
    groups: list[bool] = []  # whether the open group is a look-behind
    for piece in _PIECE.findall(pattern):
        if piece == "(?":
            return None
        if piece[0] == "(" and not piece.startswith("(?P="):
            groups.append(piece in ("(?<=", "(?<!"))
            out.append(piece)
        elif piece == ")":
            groups.pop()
            out.append(piece)
        elif piece in _AT_CUT:
            out.append(_AT_CUT[piece])
        elif any(groups) and piece[0] not in "|$*+?{" and piece not in (r"\Z",):
            if piece.startswith("(?P=") or re.fullmatch(r"\\[1-9]\d?", piece):
                return None
            out.append(rf"(?:{piece}(?!\G))")
        else:
            out.append(piece)
    return "".join(out)


def has_fuzzy_syntax(pattern: str) -> bool:
    return bool(_FUZZY.search(pattern))


def needed_strings(pattern: str) -> list[str]:
    """Strings of which each match of ``pattern`` contains at least one; ``[""]`` where none can be told.

    Of the parts that a match must have, the one whose shortest string is longest counts. Approximate patterns, patterns that ignore case
    and those that Python refuses need nothing.
    """
    if has_fuzzy_syntax(pattern):
        return [""]
    try:
        tree = re._parser.parse(pattern)
    except re.error:
        return [""]
    return [""] if tree.state.flags & re.IGNORECASE else _needed(tree) or [""]


def _needed(items) -> list[str]:
    choices: list[list[str]] = []
    run = ""
    for op, arg in items:
        kind = str(op)
        if kind == "LITERAL":
            run += chr(arg)
            continue
        choices.append([run])
        run = ""
        if kind == "SUBPATTERN" and not arg[1]:
            choices.append(_needed(arg[3]))
        elif kind == "ATOMIC_GROUP":
            choices.append(_needed(arg))
        elif kind == "BRANCH":
            each = [_needed(branch) for branch in arg[1]]
            choices.append(list(dict.fromkeys(s for found in each for s in found)) if all(each) else [])
        elif kind == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            choices.append([chr(c) for _, c in arg])
        elif kind.endswith("_REPEAT") and arg[0] > 0:
            choices.append(_needed(arg[2]))
    choices.append([run])
    return max((c for c in choices if c and all(c)), key=lambda c: (min(map(len, c)), -len(c)), default=[])
