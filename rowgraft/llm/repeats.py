"""Bytes inside strings of a given length that occur more than once in the corpus.

A depth-limited most-significant-digit radix sort of suffixes: only the first ``length`` bytes
of a suffix count, and suffixes in one group after the last pass are the repeated windows.
Passes, from coarse to fine; a group of one drops out after each:

1. The first digit of a window is its sampled gram: among its 64-byte grams the one with the
   smallest hash, the rightmost of equals.  Equal windows sample the same gram at the same
   place, and neighbouring windows mostly share theirs, so the pass sorts one row per run of
   neighbouring windows (its context) instead of one per byte.  The next digit is the whole
   context: windows of a context that occurs twice are repeated and done with, and a gram
   with no other context, or none that is still alone, is done with too.
2. What is left is cut into steps of ``STEP`` neighbours at fixed distances from the gram.  The
   first digit is the bytes that all windows of a step share, the next the whole step.
3. What is left then is sorted window by window.

Groups are formed by digests of 128 bits with partial counts, so a passage that a third of
the documents have travels as one row per task.  Each pass writes its rows once and drops those
of the pass before, tables and shuffle files.  The texts are exchanged to meet the rows that
are left, for passes 2 and 3 and for the cutting, one exchange at a time.

Passages of so many words go through the same passes beside the strings, as texts of ``TOKEN``
bytes a word, the word's hash; the windows that count begin where a word does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import CHUNK, NOT_BLANK, passing, pieces_of, slices, written

LENGTH = 400
GRAM = 64
STEP = 32
#: Words of a passage that is told where it occurs again, and of the grams that tell it.
PASSAGE = 51
WORD_GRAM = 16
#: Bytes that stand for a word.
TOKEN = 4
#: A key is heavy when it has more than one in so many runs.
HEAVY = 1000
#: Shares that the rows of a heavy key are dealt into.
SALTS = 1024
_PLACES = np.uint64((1 << 24) - 1)


def _spread(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit numbers so that all bits depend on all."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


_BYTE = _spread(_spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)))


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of each run of ``size`` bytes (a power of two), by doubling."""
    h, n = _BYTE[data], 1
    while n < size:
        h = _spread(h[:-n] * np.uint64(0xBF58476D1CE4E5B9) + h[n:])
        n *= 2
    return h


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    n = 1
    while n * 2 <= width:
        key = np.minimum(key[:-n], key[n:])
        n *= 2
    return np.minimum(key[: len(key) - (width - n)], key[width - n :]) if n < width else key


def as_tokens(text: bytes) -> bytes:
    """``TOKEN`` bytes for each word, a run of bytes without blanks."""
    return b"".join(map(xxhash.xxh32_digest, text.split()))


def few_words(data: np.ndarray, length: int, words: int) -> np.ndarray:
    """Which runs of ``length`` bytes hold fewer whole words.  Only the bytes inside tell, so equal
    runs agree; a word without a blank on either side may go on outside and is not whole."""
    within = NOT_BLANK[data]
    ended = np.cumsum(np.r_[False, within[:-1] & ~within[1:]])
    n = len(data) - length + 1
    return ended[length - 1 :] - ended[:n] - within[:n] < words


def contexts_of(data: bytes, ends: list[int], length: int, gram: int, fewer: int | None = None) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one sampled gram, in texts laid end to end:
    (first window, number of windows, hash of the gram, place of the gram).  With ``fewer`` only
    windows of fewer whole words count."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if len(data) < length:
        return none
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    # The hash above, the place from the right below: the least is the rightmost of equals.
    place = np.arange(len(h), dtype=np.uint64)
    low = _least((h & ~_PLACES) | (_PLACES - place), length - gram + 1)
    inside = np.ones(len(low), bool)
    for e in ends[:-1]:
        inside[max(0, e - length + 1) : e] = False
    if fewer is not None:
        inside &= few_words(np.frombuffer(data, np.uint8), length, fewer)
    window = np.flatnonzero(inside)
    if not len(window):
        return none
    at = (_PLACES - (low[window] & _PLACES)).astype(np.int64)
    begin = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(window) != 1)])
    count = np.diff(np.r_[begin, len(window)])
    return window[begin], count, h[at[begin]].view(np.int64), at[begin]


def _segments(rids: list[int], texts: Iterable[bytes], length: int, most: int) -> Iterator[tuple[int, int, bytes]]:
    """(rid, offset, bytes): a long text in stretches that share ``length`` - 1 bytes, so that each
    window lies in exactly one."""
    for rid, text in zip(rids, texts):
        if len(text) >= length:
            for s in range(0, max(1, len(text) - length + 1), most):
                yield rid, s, text[s : s + most + length - 1]


def _longs(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


#: Windows ``first`` to ``first + windows - 1`` of a text, ``at`` the distance from the first to the
#: sampled gram, ``alone``: not known to be repeated; ``tokens``: of the text as tokens; g and c are
#: the two digits.
UNIT = "rid long, first int, windows int, at int, alone boolean, tokens boolean, g long, c long"


def _contexts(batches: Iterator[pa.RecordBatch], length: int, gram: int, words: int | None) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        rids = batch["rid"].to_pylist()
        yield from _contexts_of(rids, texts, length, gram, words, False)
        if words is not None:
            yield from _contexts_of(rids, map(as_tokens, texts), words * TOKEN, gram, None, True)


def _contexts_of(rids: list[int], texts: Iterable[bytes], length: int, gram: int, fewer: int | None, tokens: bool) -> Iterator[pa.RecordBatch]:
    segments = list(_segments(rids, texts, length, CHUNK))
    for a, b in pieces_of(segments, size=lambda s: len(s[2])):
        part = segments[a:b]
        data = b"".join(s[2] for s in part)
        ends = np.cumsum([len(s[2]) for s in part])
        first, count, g, at = contexts_of(data, ends.tolist(), length, gram, fewer)
        owner = np.searchsorted(ends, first, side="right")
        shift = np.array([s[1] for s in part], np.int64) - np.r_[0, ends[:-1]]
        stop = first + count + length - 1
        c = _longs([xxhash.xxh3_64_intdigest(data[x:y]) for x, y in zip(first.tolist(), stop.tolist())])
        rid = np.array([s[0] for s in part], np.int64)[owner]
        yield _units(rid, first + shift[owner], count, at - first, np.ones(len(first), bool), tokens, g, c)


def _units(rid, first, windows, at, alone, tokens, g, c) -> pa.RecordBatch:
    flags = [pa.array(np.asarray(alone, bool)), pa.array(np.full(len(first), tokens))]
    columns = [pa.array(np.asarray(rid, np.int64)), *[pa.array(np.asarray(x, np.int32)) for x in (first, windows, at)], *flags, pa.array(g), pa.array(c)]
    return pa.RecordBatch.from_arrays(columns, ["rid", "first", "windows", "at", "alone", "tokens", "g", "c"])


def _left(batch: pa.RecordBatch, texts: list[bytes], length: int, words: int | None) -> Iterator[tuple[int, bytes, int, bool, np.ndarray, ...]]:
    """(rid, text, length, tokens, first, windows, at, alone) of each text with the runs left in it,
    those of the text as tokens apart."""
    own = batch["left"]
    *fields, kind = [own.flatten().field(n).to_numpy(zero_copy_only=False) for n in ("first", "windows", "at", "alone", "tokens")]
    stop = np.cumsum(own.value_lengths().to_numpy())
    for i, (rid, text) in enumerate(zip(batch["rid"].to_pylist(), texts)):
        a, b = (stop[i - 1] if i else 0), stop[i]
        for tokens in (False, True):
            of = kind[a:b].astype(bool) == tokens
            if of.any():
                yield rid, as_tokens(text) if tokens else text, words * TOKEN if tokens else length, tokens, *[f[a:b][of].astype(np.int64) for f in fields]


def _steps(batches: Iterator[pa.RecordBatch], all_length: int, step: int, words: int | None) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        for rid, text, length, tokens, first, windows, at, alone in _left(batch, texts, all_length, words):
            low, high = at - windows + 1, at  # distances from windows to the gram
            n = high // step - low // step + 1
            i = np.repeat(np.arange(len(first)), n)
            block = np.repeat(low // step, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            gram = (first + at)[i]
            near, far = np.maximum(block * step, low[i]), np.minimum(block * step + step - 1, high[i])
            begin, shared = gram - far, gram - block * step
            g = _longs([xxhash.xxh3_64_intdigest(text[x : x + length - step + 1]) for x in shared.tolist()])
            c = _longs([xxhash.xxh3_64_intdigest(text[x:y], 1) for x, y in zip(begin.tolist(), (gram - near + length).tolist())])
            yield _units(np.full(len(i), rid), begin, far - near + 1, np.zeros(len(i)), alone[i] != 0, tokens, g, c)


def _windows(batches: Iterator[pa.RecordBatch], all_length: int, words: int | None) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        for rid, text, length, tokens, first, windows, _, alone in _left(batch, texts, all_length, words):
            i = np.repeat(np.arange(len(first)), windows)
            at = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(windows) - windows, windows)
            both = b"".join([xxhash.xxh3_128_digest(text[x : x + length]) for x in at.tolist()])
            g, c = np.frombuffer(both, np.int64).reshape(-1, 2).T.copy()
            yield _units(np.full(len(i), rid), at, np.ones(len(i)), np.zeros(len(i)), alone[i] != 0, tokens, g, c)


def _matching(rows: DataFrame, keys: DataFrame, on: list[str], heavy: int) -> DataFrame:
    """The rows whose key is among ``keys`` (key columns and n, the rows a key has).

    Keys with over ``heavy`` rows are few, as ``heavy`` is a share of all rows; they are
    broadcast, and their rows are dealt by a salt of their own beside the key.
    """
    often = F.broadcast(keys.where(F.col("n") > heavy).select(*on, F.lit(True).alias("often")))
    # Salts of heavy rows begin with 1, and tell them apart from others after the join.
    own = F.when(F.col("often"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)) + 1).otherwise(F.lit(0)).cast("int")
    # Zero, told by the data: a literal would be folded out of the join, and the salt with it.
    zero = F.least(F.col("n"), F.lit(0)).cast("int")
    rare = keys.where(F.col("n") <= heavy).select(*on, zero.alias("salt"), F.lit(True).alias("rare"))
    dealt = rows.join(often, on, "left").withColumn("salt", own).drop("often")
    return dealt.join(rare, [*on, "salt"], "left").where("salt > 0 or rare").select(*rows.columns)


def _sorted_out(units: DataFrame, heavy: int) -> tuple[DataFrame, DataFrame]:
    """One pass: (runs found to be repeated, runs that need a finer pass).

    Of a context that occurs twice one run goes on, not alone, for others to be compared with."""
    contexts = units.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "first", "windows", "at", "tokens")).alias("one"), F.max("alone").alias("alone"))
    alone = F.expr("n = 1 and alone")
    grams = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max(alone).alias("open")).where("n > 1 and open")
    left = _matching(contexts.select("g", "one", alone.alias("alone")), grams, ["g"], heavy).select("one.*", "alone")
    return _repeated(units, heavy), left


def _repeated(units: DataFrame, heavy: int) -> DataFrame:
    twice = units.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _matching(units.where("alone").select("g", "c", "rid", "first", "windows", "tokens"), twice, ["g", "c"], heavy).select("rid", "first", "windows", "tokens")


def _meeting(texts: DataFrame, left: DataFrame) -> DataFrame:
    return texts.join(left.groupBy("rid").agg(F.collect_list(F.struct("first", "windows", "at", "alone", "tokens")).alias("left")), "rid")


def _word_span(run: dict, text: bytes, edges: list[np.ndarray], words: int) -> list[list[int]]:
    """Byte offsets of the words of a run of token windows; ``edges`` keeps those of the text's words."""
    if not edges:
        edges.append(np.flatnonzero(np.diff(NOT_BLANK[np.frombuffer(text, np.uint8)], prepend=False, append=False)).reshape(-1, 2))
    a, b = -(-run["first"] // TOKEN), (run["first"] + run["windows"] - 1) // TOKEN
    return [[int(edges[0][a, 0]), int(edges[0][b + words - 1, 1])]] if a <= b else []


def _cut(batches: Iterator[pa.RecordBatch], length: int, words: int | None, as_text: bool) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch, texts in slices(batches):
        size, spans, kept = [], [], []
        for text, runs in zip(texts, batch["runs"].to_pylist()):
            found: list[list[int]] = []
            own: list[list[int]] = []
            edges: list[np.ndarray] = []
            for r in runs or ():
                own += _word_span(r, text, edges, words) if r["tokens"] else [[r["first"], r["first"] + r["windows"] - 1 + length]]
            for a, b in sorted(own):
                if found and a <= found[-1][1]:
                    found[-1][1] = max(found[-1][1], b)
                else:
                    found.append([a, b])
            cuts = [0, *[x for s in found for x in s], len(text)]
            size.append(len(text))
            spans.append([{"start": a, "end": b} for a, b in found])
            kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
        rest = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        yield pa.RecordBatch.from_arrays([batch["rid"], pa.array(size, pa.int64()), pa.array(spans, spans_type), rest], ["rid", "n_bytes", "spans", "kept"])


def without_repeats(
    docs: DataFrame, text_column: str = "text", length: int = LENGTH, gram: int = GRAM, step: int = STEP, words: int | None = None, as_text: bool = False
) -> DataFrame:
    """One row per row of ``docs`` (which has a column rid, see ``numbered``): rid, n_bytes,
    ``spans`` (byte offsets removed, maximal and in order) and ``kept`` (the other bytes).

    A byte goes when some string of ``length`` bytes that covers it also starts at another
    place, in the same text or another; strings may overlap.  Null counts as the empty text;
    texts shorter than ``length`` stay whole; of equal texts nothing stays, as each repeats
    the other.  ``kept`` may begin or end within a character.  Repeated rows are separate
    texts.  An empty table gives no rows.  Other columns are not read.

    With ``words``, every passage of so many words that occurs at another place goes instead,
    whatever its bytes and the blanks between, and of the strings of ``length`` bytes those
    that hold fewer whole words (text without blanks has few).

    With ``as_text``, ``kept`` is text, without the parts of characters cut apart.
    """
    texts = docs.select("rid", F.col(text_column).alias("text"))
    with passing(docs.sparkSession) as keep:
        with passing(docs.sparkSession) as hand_on:
            every = written(texts.mapInArrow(lambda b: _contexts(b, length, gram, words), UNIT))
            heavy = every.count() // HEAVY + 1
            units = hand_on(_matching(every, every.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), ["g"], heavy))
        with passing(docs.sparkSession) as hand_on:
            done, left = map(hand_on, _sorted_out(units, heavy))
        with passing(docs.sparkSession) as hand_on:
            steps = written(_meeting(texts, left).mapInArrow(lambda b: _steps(b, length, step, words), UNIT))
            done_2, left_2 = map(hand_on, _sorted_out(steps, heavy))
        with passing(docs.sparkSession) as hand_on:
            windows = written(_meeting(texts, left_2).mapInArrow(lambda b: _windows(b, length, words), UNIT))
            done_3 = hand_on(_repeated(windows, heavy))
        found = done.unionAll(done_2).unionAll(done_3)
        runs = keep(found.groupBy("rid").agg(F.collect_list(F.struct("first", "windows", "tokens")).alias("runs")))
    met = texts.join(runs, "rid", "left")
    schema = f"rid long, n_bytes long, spans array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}"
    return met.mapInArrow(lambda b: _cut(b, length, words, as_text), schema)


def word_grams(text: bytes, passage: int = PASSAGE, gram: int = WORD_GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the sampled grams of a text: of the grams in each run of ``passage`` words
    the one with the least hash, the rightmost of equals."""
    words = np.array([xxhash.xxh3_64_intdigest(w) for w in text.split()], np.uint64)
    none = np.zeros(0, np.int64)
    if len(words) < passage:
        return none, none
    h, n = _spread(words), 1
    while n < gram:
        h = _spread(h[:-n] * np.uint64(0xBF58476D1CE4E5B9) + h[n:])
        n *= 2
    place = np.arange(len(h), dtype=np.uint64)
    low = _least((h & ~_PLACES) | (_PLACES - place % _PLACES), passage - gram + 1)
    # The low bits tell the place within a stretch; the stretch follows from the window.
    at = np.arange(len(low)) + (((_PLACES - (low & _PLACES)).astype(np.int64) - np.arange(len(low))) % int(_PLACES))
    at = np.unique(at)
    return at, h[at].view(np.int64)


def _word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        found = [word_grams(t) for t in texts]
        rid = np.repeat(batch["rid"].to_numpy(), [len(a) for a, _ in found])
        at, g = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(at.astype(np.int32)), pa.array(g)], ["rid", "at", "g"])


def shared_words(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(rid, shared_words) of the rows of ``docs`` that share a passage with another place.

    Of every 51 words in a row one gram of 16 is sampled by its hash, so a passage of 51 words
    that occurs again has such grams in common with the other place.  ``shared_words`` counts the
    words from the first to the last of them, where neighbours are less than 51 words apart: all
    of a long passage but its edges, at least 16 of a short one.
    """
    with passing(docs.sparkSession) as keep:
        grams = written(docs.select("rid", F.col(text_column).alias("text")).mapInArrow(_word_grams, "rid long, at int, g long"))
        heavy = grams.count() // HEAVY + 1
        found = keep(_matching(grams, grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), ["g"], heavy))
    zero = F.lit(0).cast("long")
    near = lambda s, x: (s["last"] >= 0) & (x - s["last"] < PASSAGE)
    total = F.aggregate(
        F.sort_array(F.collect_list("at")),
        F.struct(F.lit(-1).alias("last"), zero.alias("words")),
        lambda s, x: F.struct(x.alias("last"), (s["words"] + F.when(near(s, x), x - s["last"]).otherwise(F.lit(WORD_GRAM))).alias("words")),
        lambda s: s["words"],
    )
    return found.groupBy("rid").agg(total.alias("shared_words"))
