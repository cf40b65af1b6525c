"""Secret scans: fixed patterns, and sliding-window entropy by character class."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns; a match counts from the length beside it.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

# Character classes of the entropy scan: pattern of a candidate, least bits in a window.
WINDOW = 20
CLASSES = {
    "entropy_hex": (re.compile(r"[0-9A-Fa-f]{20,}"), 3.0),
    "entropy_base64": (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.8),
}
# Strings that look random and are no secrets.
ALLOWED = (
    re.compile(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.I),
    re.compile(r"[A-Za-z]+"),
    re.compile(r"[0-9]+"),
    re.compile(r"(?:[A-Za-z]+[-_/+=])+[A-Za-z]*"),
)
# Parts of placeholders: a window that holds one counts for nothing, those beside it do.
MARKED = re.compile(r"(?=(example|sample|placeholder|0123456789|abcdefgh|xxxx))", re.I)

_BITS = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def dense_runs(
    text: str, start: int, end: int, least: float, window: int = WINDOW, marked: list[tuple[int, int]] = (),
) -> list[tuple[int, int]]:
    """Runs of windows of text[start:end] with at least so many bits per character,
    without the windows that hold one of the marked places (in order of their starts) whole.

    A window's entropy is log2(w) - sum(c * log2(c)) / w over its character counts c;
    moving on changes two counts, so each step takes constant time.
    """
    bits = _BITS if window == WINDOW else [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    most = (math.log2(window) - least) * window + 1e-9
    counts: dict[str, int] = {}
    total, runs, k = 0.0, [], 0
    for at in range(start, end):
        n = counts.get(text[at], 0)
        counts[text[at]] = n + 1
        total += bits[n + 1] - bits[n]
        first = at - window + 1
        if first < start:
            continue
        while k < len(marked) and marked[k][0] < first:
            k += 1
        if total <= most and not (marked and any(e <= at + 1 for _, e in marked[k:k + window])):
            if runs and first <= runs[-1][1]:
                runs[-1] = (runs[-1][0], at + 1)
            else:
                runs.append((first, at + 1))
        n = counts[text[first]]
        counts[text[first]] = n - 1
        total += bits[n - 1] - bits[n]
    return runs


class Cover:
    """Whether a stretch lies within one of the given spans, in logarithmic time."""

    def __init__(self, spans: list[tuple[int, str, int]]):
        ordered = sorted((s, e) for s, _, e in spans)
        self.starts = [s for s, _ in ordered]
        self.ends = list(accumulate((e for _, e in ordered), max))

    def holds(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start)
        return k > 0 and self.ends[k - 1] >= end


def scan(text: str, allowed=ALLOWED, marked=MARKED) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """(base spans, entropy spans), each (start, kind, end) in code points.

    A candidate that fully matches an allowed pattern, or a run that does, is
    suppressed; so is a run within a base span, which already stands for it. A marker
    of placeholders takes out the windows it lies in and no more.
    """
    base = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    base += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    base += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    found: list[tuple[int, str, int]] = []
    for kind, (pattern, least) in CLASSES.items():
        known = Cover(base + found)
        for m in pattern.finditer(text):
            if any(a.fullmatch(m[0]) for a in allowed):
                continue
            places = [p.span(1) for p in marked.finditer(text, m.start(), m.end())]
            for start, end in dense_runs(text, m.start(), m.end(), least, marked=places):
                if not known.holds(start, end) and not any(a.fullmatch(text, start, end) for a in allowed):
                    found.append((start, kind, end))
    return base, found


def joined(spans: list[tuple[int, str, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in ordered)


OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, base_sha256 string, spans string"


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed=ALLOWED, marked=MARKED) -> DataFrame:
    """One row per input row: doc_id, counts, base_spans, base_sha256, spans.

    Spans are places, never values. A null text counts as empty: no spans, the digest
    of the empty string. Rows are independent, so repeated rows repeat; long texts
    and long candidates take time in proportion; other columns are not read. No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, found = scan(text.as_py(), allowed, marked)
                kinds = [s[1] for s in base]
                listed = joined(base)
                rows.append((*map(kinds.count, KINDS[:3]), listed, hashlib.sha256(listed.encode()).hexdigest(), joined(base + found)))
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "base_sha256", "spans"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, OUT)
