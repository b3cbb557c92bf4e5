"""Find secrets: known patterns, and tokens that look random.

A candidate token is a long run of the characters of one encoding, or of the
letters and digits between separators; numbers are none.  Its encoding (hex, base32 or base64) gives the alphabet that a random key
would use evenly, and three tests ask whether it does: chi-squared uniformity
over alphabet bins (fewer bins for short tokens), a runs test around the
middle of the alphabet, and the serial correlation of neighbouring symbols.
Fisher's method combines them to one p-value.

Real keys have p-values that are even over (0, 1); words and identifiers pile
up near 0, but the shorter a token, the higher a p-value it reaches by chance.
So the share of false finds is controlled per encoding, length class and presence of digits
over the whole corpus: from the histogram of p-values, the smallest cut-off is
taken above which the estimated share of non-random tokens is at most
``max_false``.  Only that histogram (some thousand counters) reaches the driver.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: parts of a token that are tested: by either base64 alphabet, and between all separators
_PARTS = tuple(re.compile(p) for p in (r"[A-Za-z0-9+/]{16,}", r"[A-Za-z0-9_-]{16,}", r"[A-Za-z0-9]{16,}"))
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")
#: encoding -> (full match, alphabet in code order)
_ENCODINGS = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), "0123456789abcdef"),
    ("base32", re.compile(r"[A-Z2-7]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", re.compile(r"[A-Za-z0-9+/]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", re.compile(r"[A-Za-z0-9_-]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_CODES = {name: {c: i for i, c in enumerate(alphabet)} for name, _, alphabet in _ENCODINGS}
_LENGTHS = (16, 24, 40, 80)  # lower bounds of the length classes
_STRATA = len(_ENCODINGS) * 2 * len(_LENGTHS)
_BINS = 100


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared (Wilson and Hilferty's cube root)."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * df)
    return _normal_tail(((x / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def randomness(symbols: np.ndarray, size: int) -> float:
    """p-value of "every symbol of an alphabet of ``size`` is equally likely
    and independent of its neighbours"."""
    n = len(symbols)
    bins = min(size, max(2, n // 4))
    seen = np.bincount(symbols * bins // size, minlength=bins)
    share = np.bincount(np.arange(size) * bins // size, minlength=bins) / size
    uniform = _chi2_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), bins - 1)

    high = symbols >= size // 2
    a = int(high.sum())
    b = n - a
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        run = 2 * _normal_tail(abs(runs - mean) / math.sqrt(max(var, 1e-9)))
    else:
        run = 2.0 ** (1 - n)

    centred = symbols - symbols.mean()
    power = float((centred ** 2).sum())
    serial = (centred[1:] * centred[:-1]).sum() / power if power else 1.0
    serial_p = 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n))

    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, run, serial_p))
    return math.exp(-half) * (1 + half + half * half / 2)


def candidates(text: str) -> Iterator[tuple[int, int, int, float]]:
    """(start, end, stratum, p-value) of the tokens that could be keys; the
    stratum is encoding, whether there are digits, and length class.  Parts of
    a token overlap; those without a letter are numbers."""
    for m in _TOKEN.finditer(text):
        last = m.start() + len(m[0].rstrip("="))
        for start, end in sorted({part.span() for cut in _PARTS for part in cut.finditer(text, m.start(), last)}):
            token = text[start:end]
            if not _LETTER.search(token):
                continue
            for kind, (name, whole, alphabet) in enumerate(_ENCODINGS):
                if whole.fullmatch(token):
                    codes = _CODES[name]
                    symbols = np.array([codes[c] if c in codes else codes[c.lower()] for c in token])
                    size = sum(len(token) >= low for low in _LENGTHS) - 1
                    stratum = (2 * kind + (_DIGIT.search(token) is None)) * len(_LENGTHS) + size
                    yield start, m.end() if end == last else end, stratum, randomness(symbols, len(alphabet))
                    break


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the known patterns, leftmost and
    non-overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def cut_offs(docs: DataFrame, text_col: str = "text", max_false: float = 0.1) -> dict[int, float]:
    """Smallest p-value, by stratum, from which a token counts as random.

    The tokens above p = 0.5 estimate how many are random in all (twice as
    many); beyond a cut-off t the random ones should number (1 - t) of that,
    and what is above this share is taken for false."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((_STRATA, _BINS), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, _, stratum, p in candidates(text or ""):
                    counts[stratum, min(int(p * _BINS), _BINS - 1)] += 1
        stratum, at = np.nonzero(counts)
        yield pa.record_batch([pa.array(stratum), pa.array(at), pa.array(counts[stratum, at])], names=["stratum", "bin", "n"])

    counts = np.zeros((_STRATA, _BINS))
    histogram = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "stratum long, bin long, n long")
    for r in histogram.groupBy("stratum", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["stratum"], r["bin"]] = r["n"]
    out = {}
    for stratum, n in enumerate(counts):
        random = min(2 * n[_BINS // 2:].sum(), n.sum())
        above = np.cumsum(n[::-1])[::-1]
        expected = random * (1 - np.arange(_BINS) / _BINS)
        false = np.maximum(above - expected, 0) / np.maximum(above, 1)
        fine = np.flatnonzero((false[1:] <= max_false) & (above[1:] > 0)) + 1  # p below 0.01 always fails
        if len(fine):
            out[stratum] = float(fine[0] / _BINS)
    return out


def find_secrets(docs: DataFrame, text_col: str = "text", max_false: float = 0.1, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with ``secrets``: an
    array of (kind, start, end), by start, then kind; code points, end
    exclusive.  Random tokens inside the span of a known pattern or of another
    random token are not repeated.

    A null or empty text has no secrets; repeated rows and null ids are rows
    like any other; an empty table gives an empty result; an input column
    ``secrets`` is replaced."""
    cuts = cut_offs(docs, text_col, max_false)
    carry = [c for c in (docs.columns if carry is None else carry) if c != "secrets"]
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([docs.schema[c] for c in carry] + [StructField("secrets", ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                found = base_spans(text or "")
                known = sorted((s, e) for s, _, e in found)
                starts, reach = [s for s, _ in known], list(accumulate((e for _, e in known), max))
                random = sorted((start, -end) for start, end, stratum, p in candidates(text or "") if p >= cuts.get(stratum, 2.0))
                upto = 0
                for start, end in ((start, -end) for start, end in random):
                    at = bisect_right(starts, start)  # a known span that starts no later and ends no earlier
                    if end > upto and not (at and reach[at - 1] >= end):
                        found.append((start, 3, end))
                    upto = max(upto, end)
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)])
            yield pa.record_batch([*batch.columns[:-1], pa.array(out, arrow)], names=[*carry, "secrets"])

    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).alias("__text")).mapInArrow(run, schema)
