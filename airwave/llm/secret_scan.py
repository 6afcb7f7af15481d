"""Secret scans by a battery of randomness tests.

Fixed patterns give the base spans. Beside them, every run of token characters that has two kinds of characters (digits, upper
case, lower case) is a candidate in the smallest encoding that fits. Under the hypothesis that it is random in its encoding, tests
give p-values: chi-squared uniformity over the alphabet and over its kinds of characters, the runs test above and below the
middle of the alphabet (corrected for continuity), and serial correlation of neighbours (corrected for its mean). Tokens are
short for their alphabets, so the tail of chi-squared is that of a gamma with the statistic's exact first three moments. The
tests look at one string and are not independent, so the Cauchy combination joins them, whose small p-values hold under
dependence; Fisher's method would not.

A candidate is taken for text, not for a secret, where randomness is rejected with the false-discovery rate held at FDR
within its length class (a secret that is thrown away is the false discovery). The threshold of a class is the largest
point of a fixed grid of p-values at which class size times p is at most FDR times the rejections, which needs only
counts by class and grid point: a small table of fixed size, whatever the corpus. Short candidates, for which the tests
have no power, are not tested.

Defined cases: null text is empty; spans are in code points, end exclusive; equal rows get equal results; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import KEY, map_batches, row_key, staged, utf8
from airwave.llm.rewrite import rewrite_text

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: Candidates of the battery have this length at least; their classes end below these lengths.
LEAST_RANDOM, CLASSES = 20, (24, 32, 48, 64, 128)
FDR = 0.05
#: Grid of p-values: ten points to a power of ten, down to 1e-30.
GRID_STEPS, GRID_LAST = 10, 300

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX, _TOKEN = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b"0123456789abcdef")] |= _HEX
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] |= _TOKEN
_DIGITS = "0123456789"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: From the smallest alphabet to the largest.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "upper36": _UPPER + _DIGITS,
    "lower36": _LOWER + _DIGITS,
    "letters": _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "token": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_ORDER = {name: {c: i for i, c in enumerate(chars)} for name, chars in ENCODINGS.items()}
#: The kind of each character - upper case, lower case, or another - and the share of each kind that an encoding has.
_KIND_OF, _KIND_SHARES = {}, {}
for _name, _chars in ENCODINGS.items():
    _own = np.unique([0 if c in _UPPER else 1 if c in _LOWER else 2 for c in _chars], return_inverse=True)[1]
    _KIND_OF[_name], _KIND_SHARES[_name] = _own, np.bincount(_own) / len(_chars)
_SPAN = "array<struct<kind:string,start:long,end:long>>"
_CANDIDATE = "array<struct<start:long,end:long,grid:int,klass:int,encoding:string>>"


def infer_encoding(token: str) -> str | None:
    """The smallest encoding that fits; none for one kind of characters, which is a word or a number."""
    body = token.rstrip("=")
    kinds = (any(c in _DIGITS for c in body), any(c in _UPPER for c in body), any(c in _LOWER for c in body))
    if len(body) < LEAST_RANDOM or sum(kinds) < 2:
        return None
    chars = set(body)
    return next((name for name, order in _ORDER.items() if chars <= order.keys()), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: float) -> float:
    """Upper tail of chi-squared by Wilson and Hilferty's cube root."""
    if df == 2:
        return math.exp(-max(x, 0.0) / 2)
    z = ((max(x, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(counts: np.ndarray, n: int) -> float:
    """The p-value of equal chances for all characters.

    Counts are small, so the statistic is compared to a gamma of its own mean, variance and third moment (given by the size
    of the alphabet and n), less half of the step between its values.
    """
    size = len(counts)
    x = float((counts.astype(float) ** 2).sum()) * size / n - n - size / n
    variance = 2 * (size - 1) * (n - 1) / n
    skew = 4 * (size - 1) * (n - 1) * (2 * n + size - 6) / n**2 / variance**1.5
    df = 8 / skew**2
    return _chi2_tail(df + (x - (size - 1)) / math.sqrt(variance) * math.sqrt(2 * df), df)


def battery(token: str, encoding: str) -> float:
    """The joint p-value of the tests under the hypothesis that the token is random in its encoding."""
    order = _ORDER[encoding]
    x = np.array([order[c] for c in token.rstrip("=")])
    n, size = len(x), len(order)
    uniform = uniformity(np.bincount(x, minlength=size), n)
    share = _KIND_SHARES[encoding]
    expect = n * share
    seen = np.bincount(_KIND_OF[encoding][x], minlength=len(share))
    kinds = _chi2_tail(float(((seen - expect) ** 2 / expect).sum()), len(share) - 1) if len(share) > 2 else _normal_tail(
        max(0.0, abs(seen[0] - expect[0]) - 0.5) / math.sqrt(n * share[0] * share[1])
    )
    high = x >= size / 2
    ups = int(high.sum())
    downs = n - ups
    if ups and downs:
        mean = 1 + 2 * ups * downs / n
        variance = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = _normal_tail(max(0.0, abs(1 + int((high[1:] != high[:-1]).sum()) - mean) - 0.5) / math.sqrt(variance))
    else:
        runs = 2.0 ** (1 - n)
    off = x - x.mean()
    spread = float((off**2).sum())
    serial = 0.0
    if spread:
        serial = _normal_tail((float((off[1:] * off[:-1]).sum()) / spread + 1 / n) * n / math.sqrt(n - 1))
    return cauchy((uniform, kinds, runs, serial))


def cauchy(ps: tuple[float, ...]) -> float:
    """The Cauchy combination of p-values; tan((0.5 - p) * pi) is 1 / (p * pi) for small p.

    A p-value near 1 would outweigh a small one, so none counts above 0.9.
    """
    tan = (1 / (max(p, 1e-300) * math.pi) if p < 1e-10 else math.tan((0.5 - min(p, 0.9)) * math.pi) for p in ps)
    mean = sum(tan) / len(ps)
    return 1 / (mean * math.pi) if mean > 1e9 else 0.5 - math.atan(mean) / math.pi


def grid_point(p: float) -> int:
    """The first grid point at or above p, counted from 1 downwards."""
    return min(GRID_LAST, int(math.floor(-math.log10(max(p, 1e-300)) * GRID_STEPS)))


def length_class(n: int) -> int:
    return sum(n >= edge for edge in CLASSES)


def _runs(bits: np.ndarray, least: int) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate((np.zeros(1, np.int8), bits, np.zeros(1, np.int8)))))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return list(zip(start[long].tolist(), end[long].tolist(), strict=True))


def scan(data: bytes) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, int, int, str]]]:
    """Base spans, and the candidates of the battery outside them (start, end, grid point, class, encoding)."""
    kinds = _CLASS[np.frombuffer(data, np.uint8)]
    base = []
    low = data.lower()
    if any(k in low for k in _KEYWORDS):
        base += [("assign", *m.span()) for m in ASSIGN.finditer(data) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in data:
        base += [("access", *m.span()) for m in ACCESS.finditer(data) if len(m[0]) >= LEAST_ACCESS]
    base += [("hex", a, b) for a, b in _runs((kinds & _HEX).astype(np.int8), LEAST_HEX)]
    taken: list[tuple[int, int]] = []  # what base spans cover, as stretches apart
    for a, b in sorted(s[1:] for s in base):
        if taken and a <= taken[-1][1]:
            taken[-1] = taken[-1][0], max(b, taken[-1][1])
        else:
            taken.append((a, b))
    more = []
    for a, b in _runs((kinds >> 1 & 1).astype(np.int8), LEAST_RANDOM):
        b += 2 if data[b : b + 2] == b"==" else data[b : b + 1] == b"="
        token = data[a:b].decode()
        last = bisect.bisect_left(taken, (b,)) - 1  # the last stretch that starts before the end of this run
        if (encoding := infer_encoding(token)) and (last < 0 or taken[last][1] <= a):
            more.append((a, b, grid_point(battery(token, encoding)), length_class(b - a), encoding))
    if base or more:  # bytes to code points
        marks = sorted({x for s in base for x in s[1:]} | {x for s in more for x in s[:2]})
        place, seen, last = {}, 0, 0
        for x in marks:
            seen, last = seen + len(data[last:x].decode()), x
            place[x] = seen
        base = sorted(((k, place[a], place[b]) for k, a, b in base), key=lambda s: (s[1], KINDS.index(s[0])))
        more = [(place[a], place[b], *rest) for a, b, *rest in more]
    return base, more


def _scanned(batch: pa.RecordBatch) -> dict[str, list]:
    base, more = zip(*map(scan, utf8(batch)), strict=True)
    names = ("start", "end", "grid", "klass", "encoding")
    return {
        "key": batch.column(0),
        "doc_id": batch.column(1),
        "base": [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in base],
        "candidates": [[dict(zip(names, c, strict=True)) for c in x] for x in more],
    }


def thresholds(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """For each length class the largest p-value, as a grid point, at which randomness is rejected."""
    tested = scanned.select(F.explode("candidates").alias("c")).groupBy("c.klass", "c.grid").count().collect()  # classes x grid at most
    limits = {}
    for klass in {r.klass for r in tested}:
        counts = {r.grid: r["count"] for r in tested if r.klass == klass}
        total, rejected, limit = sum(counts.values()), 0, GRID_LAST + 1
        for grid in sorted(counts, reverse=True):  # from the smallest p-value up
            rejected += counts[grid]
            if total * 10 ** (-grid / GRID_STEPS) <= fdr * rejected:
                limit = grid
        limits[klass] = limit
    return limits


def secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Every row of docs with its base spans and all spans, as arrays of (kind, start, end)."""
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    scanned = staged(map_batches(rows, _scanned, f"key {KEY}, doc_id long, base {_SPAN}, candidates {_CANDIDATE}", slices=True), "secret-candidates")
    limits = thresholds(scanned, fdr)
    limit = F.create_map(*(F.lit(x) for kv in limits.items() for x in kv)) if limits else F.lit(None).cast("map<int,int>")
    random = F.transform(
        F.filter("candidates", lambda c: c["grid"] < limit[c["klass"]]),
        lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    kind_order = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    spans = F.array_sort(F.transform(F.concat("base", random), lambda s: F.struct(s["start"], kind_order[s["kind"]].alias("k"), s["end"], s["kind"])))
    return scanned.select("key", "doc_id", "base", F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("spans"))


def _listed(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secret_scan(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secrets(docs).select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans")
    )


def base_digest(spans: list[tuple[str, int, int]]) -> str:
    """What op8 hashes, for tests."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def masked(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """The documents with every span replaced by a mark of its kind; n_chars is counted anew. No document goes."""
    found = secrets(docs, fdr).where(F.size("spans") > 0).select("key", "spans").distinct()

    def mask(text: str, spans: list[dict]) -> str:
        out, last = [], 0
        for s in spans:
            if s["start"] >= last:
                out += [text[last : s["start"]], f"<{s['kind']}>"]
            last = max(last, s["end"])
        return "".join([*out, text[last:]])

    return rewrite_text(docs, row_key("doc_id", "text"), found, "spans", mask)
