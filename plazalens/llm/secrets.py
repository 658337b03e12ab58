"""Secret scans: known shapes of credentials, and tokens that a battery of randomness tests tells from words.

A token's symbols are held against what its encoding would give if they were drawn at random. Ordinary tokens repeat letters
unevenly, alternate vowels and consonants, or count up. Each test gives a statistic whose spread among *ordinary* text follows from
the token's length; the combined probability that ordinary text looks this random goes through false-discovery control, one length
class at a time, over the distinct tokens of all documents.
"""

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import need, parked

# Shapes of the base, fixed values; the second entry is the group that has to be so long
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = [("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24)]
KINDS = ("assign", "access", "hex", "random")

MIN_TOKEN = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN)
# Encodings by their alphabets, the narrowest that holds a token is taken. Fixed values
ENCODINGS = [
    ("decimal", re.compile(r"[0-9]+"), "0123456789"),
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), "0123456789abcdef"),
    ("base32", re.compile(r"[A-Z2-7]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", re.compile(r"[a-z0-9]+|[A-Z0-9]+"), "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", re.compile(r"[A-Za-z0-9]+"), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", re.compile(r"[A-Za-z0-9+/_-]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
# Excess of the sum of squared shares over the uniform one that words of each encoding have at least. Fixed values
WORD_EXCESS = {"decimal": 0.10, "hex": 0.06, "base32": 0.045, "base36": 0.045, "base62": 0.05, "base64": 0.05}
WORD_CLASSES = 0.12  # how often neighbours of a word differ in kind (lower, upper, digit, other), at most
ALPHA = 0.01  # false discoveries among what is reported
BINS = 2800  # of -ln(p), two to a unit: as far as two probabilities of 1e-300 go
LENGTHS = (32, 64, 128)  # borders of the length classes


def _norm_below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def encoding(token: str) -> tuple[str, str]:
    body = token.rstrip("=")
    return next(((name, letters) for name, shape, letters in ENCODINGS if shape.fullmatch(body)), ("base64", ENCODINGS[-1][2]))


def battery(token: str) -> tuple[float, float, float]:
    """Probabilities that ordinary text of the token's encoding and length gives statistics as random as the token's.

    Uniformity: chi-squared over the alphabet; among words it is noncentral with ``n * k * excess``. Runs: neighbours of unlike
    kind (lower, upper, digit); among words they are few. Serial correlation of neighbouring symbols: near 0 if random, and the
    token is no candidate where it is far from 0 (counted-up or repeated patterns).
    """
    body = token.rstrip("=")
    name, letters = encoding(token)
    n, k = len(body), len(letters)
    folded = body.lower() if name in ("hex", "base36") else body.replace("-", "+").replace("_", "/")
    place = {c: i for i, c in enumerate(letters)}
    values = [place[c] for c in folded]
    counts = [0] * k
    for v in values:
        counts[v] += 1
    chi2 = k / n * sum(c * c for c in counts) - n
    far = (n - 1) * k * WORD_EXCESS[name]
    uniform = _norm_below((chi2 - (k - 1 + far)) / math.sqrt(2 * (k - 1 + 2 * far)))
    kinds = [_kind(c) for c in body]
    changes = sum(a != b and a < 3 and b < 3 for a, b in zip(kinds, kinds[1:]))  # separators join words, they don't count
    runs = 0.5 * math.erfc((changes - (n - 1) * WORD_CLASSES) / math.sqrt(2 * (n - 1) * WORD_CLASSES * (1 - WORD_CLASSES)))
    mean = sum(values) / n
    spread = sum((v - mean) ** 2 for v in values) or 1.0
    serial = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / spread
    # two-sided: how likely random symbols are as correlated as these
    independent = math.erfc(abs(serial) * math.sqrt(n / 2))
    return uniform, runs, independent


def suspicion(token: str) -> float:
    """-ln of the combined probability (Fisher's method over uniformity and runs) that the token is ordinary; 0 if its symbols
    follow each other too regularly for a random draw."""
    uniform, runs, independent = battery(token)
    if independent < 1e-3:
        return 0.0
    if encoding(token)[0] == "decimal":  # digits have one kind only
        return -math.log(max(uniform, 1e-300))
    x = -math.log(max(uniform, 1e-300)) - math.log(max(runs, 1e-300))
    return x - math.log1p(x)


def length_class(n: int) -> int:
    return sum(n >= b for b in LENGTHS)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost non-overlapping per kind; too short matches use up their text and are dropped."""
    found = []
    for kind, shape, group, least in BASE:
        if kind == "assign" and ":" not in text and "=" not in text:
            continue
        found += [(m.start(), m.end(), kind) for m in shape.finditer(text) if len(m[group]) >= least]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, known: list[tuple[int, int, str]]) -> list[tuple[int, int, float]]:
    """(start, end, suspicion) of the tokens that touch no known span."""
    out, i = [], 0
    for m in TOKEN.finditer(text):
        while i < len(known) and known[i][1] <= m.start():
            i += 1
        if all(e <= m.start() or s >= m.end() for s, e, _ in known[i : i + 8]) and (score := suspicion(m[0])) > 0:
            out.append((m.start(), m.end(), score))
    return out


SCANNED = "base array<struct<start:long,stop:long,kind:string>>, tokens array<struct<start:long,stop:long,score:double,bin:int,hash:long>>"
_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())]))
_TOKENS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64()), ("bin", pa.int32()), ("hash", pa.int64())]))


def _bin(n: int, score: float) -> int:
    return length_class(n) * BINS + min(BINS - 1, int(2 * score))


def _hash(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little", signed=True)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, tokens = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            known = base_spans(text)
            base.append([{"start": s, "stop": e, "kind": k} for s, e, k in known])
            found = candidates(text, known)
            tokens.append([{"start": s, "stop": e, "score": x, "bin": _bin(e - s, x), "hash": _hash(text[s:e])} for s, e, x in found])
        columns = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(base, _TYPE), pa.array(tokens, _TOKENS)], names=[*names, "base", "tokens"])


def thresholds(scanned: DataFrame, alpha: float = ALPHA) -> dict[int, int]:
    """For each length class the lowest bin whose tokens are reported (Benjamini-Hochberg over the binned probabilities of the
    distinct tokens: however often one occurs, it counts once)."""
    tokens = scanned.select(F.explode("tokens").alias("t")).select("t.bin", "t.hash").distinct()
    counts = tokens.groupBy("bin").count().collect()  # BINS * 4 rows at most
    by = {r["bin"]: r["count"] for r in counts}
    out = {}
    for group in range(len(LENGTHS) + 1):
        total = sum(by.get(group * BINS + b, 0) for b in range(BINS))
        above, least = 0, BINS
        for b in range(BINS - 1, 0, -1):
            above += by.get(group * BINS + b, 0)
            if above and math.log(total) - b / 2 <= math.log(alpha * above):
                least = b
        out[group] = least
    return out


def find_secrets(docs: DataFrame, *keep: str, alpha: float = ALPHA) -> DataFrame:
    """``keep`` and array ``spans`` (start, stop, kind) of every row of ``docs`` (text), in code points, end exclusive, ordered by
    start and then by kind as in KINDS.

    Null and empty texts have no spans, repeated rows repeat, an empty table gives an empty result. Texts are read once; only spans
    are stored, and the report border of each length class comes from counts of a fixed number of bins.
    """
    names = list(dict.fromkeys(keep))
    rows = need(docs, *dict.fromkeys([*names, "text"])).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], "text")
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], SCANNED])
    scanned = parked(rows.mapInArrow(_scan, schema), "spans")
    border = thresholds(scanned, alpha)
    limits = F.array(*[F.lit(g * BINS + border[g]) for g in sorted(border)])
    tops = [(g + 1) * BINS for g in sorted(border)]

    def reported(t):
        ok = F.lit(False)
        for g, top in enumerate(tops):
            ok = ok | ((t["bin"] >= limits[g]) & (t["bin"] < top))
        return ok

    more = F.transform(
        F.filter("tokens", reported),
        lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), F.lit("random").alias("kind")),
    )
    order = {k: i for i, k in enumerate(KINDS)}

    def before(a, b):
        rank = lambda s: sum((F.when(s["kind"] == k, i).otherwise(0) for k, i in order.items()), F.lit(0))
        by_kind = F.when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0)
        return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(by_kind)

    spans = F.when(F.size(more) == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", more), before))
    return scanned.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)], spans.alias("spans"))


def joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest_of_base(spans) -> F.Column:
    return F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "random")), 256)


def count_of(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span replaced by ``mark``; overlapping spans become one."""
    out, at = [], 0
    for start, stop in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return "".join(out) + text[at:]
