"""Fill-in-the-middle texts, cut at ranks of words by indexable skip lists.

A text is a list of units, words with the blanks before them.  Lane 0 of its skip list links
every unit with the next one, each lane above about a fourth of the units of the lane below,
and every link carries its width twice: the units and the code points it passes.  A rank is
found by running along a lane while the next width still fits, then descending; the code
points passed on the way are the cut.  The lists of all texts of a chunk lie in the same
arrays, and their searches take each step together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import Joined, free_name, slices, unit_ends

SEED = 42
#: Of a hundred texts, how many are cut, and of a hundred that are cut, how many begin with the suffix.
RATE = 50
SUFFIX_FIRST = 80
#: Fixed marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit is on the next lane with one chance in four.
LANE_BITS = 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


class SkipLists:
    """One skip list for each text; ``units`` holds their numbers of units, ``passed`` for every
    unit of all texts, in order, the code points of its text up to its end."""

    def __init__(self, units: np.ndarray, passed: np.ndarray):
        first = np.r_[0, np.cumsum(units + 1)[:-1]].astype(np.int64)
        head = np.zeros(int(units.sum()) + len(units), bool)
        head[first] = True
        text = np.cumsum(head) - 1
        rank = np.arange(len(head)) - first[text]
        chars = np.zeros(len(head), np.int64)
        chars[~head] = passed
        height = _mixed(rank.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        #: From the lowest lane: (units to the next node, code points to it, the node's place one lane below).
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        node, below = np.arange(len(head)), np.arange(len(head))
        while len(node) > len(units) or not self.lanes:
            same = np.r_[text[node][1:] == text[node][:-1], False] if len(node) else np.zeros(0, bool)
            width, length = (np.where(same, np.r_[x[node][1:], 0] - x[node], 0) for x in (rank, chars))
            self.lanes.append((width, length, below))
            mask = np.uint64((1 << LANE_BITS * len(self.lanes)) - 1)
            below = np.flatnonzero(head[node] | (height[node] & mask == 0))
            node = node[below]
        #: A head keeps its order, so at the top, where only heads would follow, it is looked up once.
        self.top = below

    def seek(self, ranks: np.ndarray) -> np.ndarray:
        """Code points of each text before its unit of this rank (at most its number of units)."""
        at, left, passed = self.top.copy(), ranks.astype(np.int64), np.zeros(len(ranks), np.int64)
        for k in range(len(self.lanes) - 1, -1, -1):
            width, length, below = self.lanes[k]
            going = np.arange(len(ranks))
            while len(going):
                step = width[at[going]]
                going = going[(step > 0) & (step <= left[going])]
                left[going] -= width[at[going]]
                passed[going] += length[at[going]]
                at[going] += 1
            at = below[at]
        return passed


def _numbers(seed: int, key: object) -> list[int]:
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]


def cut_texts(texts: list[bytes], keys: list, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> list[tuple[int, str, int | None, int | None, str]]:
    """(units, form, code points of the prefix, of the middle, output) of each text."""
    joined = Joined(texts)
    ends = unit_ends(joined)
    units = np.searchsorted(ends, joined.end, side="right") - np.searchsorted(ends, joined.start, side="right")
    # Code points up to each place, counted by the bytes that begin one.
    points = np.r_[0, np.cumsum(joined.bytes & 0xC0 != 0x80)]
    lists = SkipLists(units, points[ends] - np.repeat(points[joined.start], units))
    h = [_numbers(seed, k) for k in keys]
    picks = np.array([[a % (n + 1), b % (n + 1)] for (a, b, _, _), n in zip(h, units.tolist())], np.int64).reshape(-1, 2)
    low, high = lists.seek(picks.min(axis=1)), lists.seek(picks.max(axis=1))
    out = []
    for raw, n, (_, _, h3, h4), a, b in zip(texts, units.tolist(), h, low.tolist(), high.tolist()):
        text = raw.decode()
        if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            out.append((n, "plain", None, None, text))
            continue
        prefix, middle, suffix = PREFIX + text[:a], MIDDLE + text[a:b], SUFFIX + text[b:]
        form = "spm" if h4 % 100 < suffix_first else "psm"
        out.append((n, form, a, b - a, (suffix + prefix if form == "spm" else prefix + suffix) + middle))
    return out


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Every row with ``n_units``, ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain) and ``output``, the text in the order of its form.

    The numbers come from a hash of the seed and the id (null: the empty text), so rows with one
    id are cut at the same numbers.  Null counts as the empty text; empty texts and texts that
    hold a mark stay plain.  Repeated rows are told nothing of each other, an empty table gives
    no rows, and a column of ``docs`` with one of these names keeps it: the new one gets an
    underscore.  A text of any length is handled alone, in arrays of its own size.
    """
    fields = (("n_units", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string"))
    names = [free_name(docs, n) for n, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch, texts in slices(batches, text_column):
            columns = zip(*cut_texts(texts, batch[id_column].to_pylist(), seed, rate, suffix_first))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns, kinds)], [*batch.schema.names, *names])

    return docs.mapInArrow(run, docs.select("*", *[F.lit(None).cast(t).alias(n) for n, (_, t) in zip(names, fields)]).schema)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of.  Texts with marks stay plain, and a mark cannot arise where
    two parts meet, so the three marks of an output are its only ones."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
