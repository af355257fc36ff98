"""Items above a size limit cut into overlapping pieces at natural boundaries.

Every place between two characters has a boundary strength (paragraph, line,
sentence, clause, word, none).  A sparse table answers range-maximum queries:
each piece ends at the strongest place of its permissible window, the rightmost
of equals, and the next piece starts ``overlap`` characters before that end.
Where that window holds no pause, ``pieces`` ends at the strongest place before
it, so a piece may be shorter than ``LEAST``.

Defined results: null texts and texts within the limit give no pieces; a text
is cut at the limit where no pause lies between the overlap and the limit; sizes count code points; the pieces,
without the overlaps, concatenate to the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest piece, characters shared by neighbours, and smallest piece as a share of the largest (but for the last, and before unbroken text).
LIMIT, OVERLAP, LEAST = 1500, 150, 0.5
#: Boundaries, the strongest first; a place lies behind what the pattern matches.
BOUNDARIES = [re.compile(p) for p in (r"\n\s*\n\s*", r"\n\s*", r"[.!?。！？…]+[)\]”’\"']*\s+|[。！？]", r"[;:,、；：—–]\s+|[、；：]", r"\s+")]
#: Places held in one sparse table; longer texts are indexed slab by slab.
SLAB = 1 << 16


def strengths(text: str) -> np.ndarray:
    """Strength of a cut before each character and at the end; 0 where the text doesn't pause."""
    out = np.zeros(len(text) + 1, np.int8)
    for strength, pattern in zip(range(len(BOUNDARIES), 0, -1), BOUNDARIES):
        ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
        out[ends] = np.maximum(out[ends], strength)
    return out


class RangeMaximum:
    """Sparse table over (strength, place), so that the maximum is the rightmost of the strongest."""

    def __init__(self, strength: np.ndarray, widest: int) -> None:
        keys = (strength.astype(np.int64) << 32) | np.arange(len(strength))
        self.levels = [keys]
        width = 1
        while 2 * width <= min(widest, len(keys)):
            last = self.levels[-1]
            self.levels.append(np.maximum(last[: len(last) - width], last[width:]))
            width *= 2

    def rightmost(self, lo: int, hi: int) -> int:
        """The place of the maximum in [lo, hi)."""
        k = min((hi - lo).bit_length() - 1, len(self.levels) - 1)
        level = self.levels[k]
        return int(max(level[lo], level[hi - (1 << k)])) & 0xFFFFFFFF


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP, least: float = LEAST, early: bool = False) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text; with ``early``, a pause below the least size goes before a cut inside unbroken text."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    if len(text) <= limit:
        return [(0, len(text))]
    strength = strengths(text)
    out, start, base, table = [], 0, 0, None
    shortest = max(overlap + 1, int(limit * least))
    while len(text) - start > limit:
        first, lo, hi = start + overlap + 1, start + shortest, start + limit + 1
        if table is None or hi > base + len(table.levels[0]):
            base = first
            table = RangeMaximum(strength[base : base + max(SLAB, limit + 1)], limit + 1)
        end = base + table.rightmost(lo - base, hi - base)
        if early and not strength[end] and first < lo:
            before = base + table.rightmost(first - base, lo - base)
            end = before if strength[before] else end
        out.append((start, end))
        start = end - overlap
    return [*out, (start, len(text))]


def pieces(df: DataFrame, keys: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(keys, piece_no, start, end, piece) of the items longer than the limit.  No shuffle; items within the limit never leave the JVM."""
    small = df.select(*keys, F.col(text).alias("_text")).where(F.length("_text") > limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*r[:-1], n, a, b, r[-1][a:b]) for r in batch.itertuples(index=False, name=None) for n, (a, b) in enumerate(cuts(r[-1], limit, overlap, early=True), 1)]
            yield pd.DataFrame(rows, columns=[*keys, "piece_no", "start", "end", "piece"])

    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return small.mapInPandas(run, f"{schema}, piece_no int, start int, end int, piece string")
