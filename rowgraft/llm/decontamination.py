"""Passages of test items in training texts, by a positional inverted index.

The index holds, for every block of neighbouring documents, the positions of every word as one
packed row, written to the shared folder.  A window of an item is looked up from its rarest
word (counted over the whole index): only blocks that hold this word are visited, and there
its positions, moved back by the word's place in the window, are intersected with those of
the next rarest word and so on until none or all words are through.  With ``slop`` each word
may stand that many places off, which finds passages with small insertions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import WORD, numbered, slices, text_bytes, words_of, written

WINDOW = 10
#: Bytes of text of an index block.
BLOCK = 8 << 20


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows (block, term, n, postings) and document rows (block, rid, n words, first)."""
    names = ["block", "rid", "first", "term", "n", "postings"]
    for batch, texts in slices(batches, most=BLOCK):
        rids, m = batch["rid"], len(batch)
        words, counts = words_of(texts, WORD)
        block = rids[0].as_py()
        # An empty place after each text keeps windows from crossing into the next.
        first = np.cumsum(counts + 1) - counts - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), rids, pa.array(first), pa.nulls(m, pa.binary()), pa.array(counts), pa.nulls(m, pa.binary())], names)
        if not len(words):
            continue
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        place = (np.arange(len(code)) + np.repeat(np.arange(m), counts))[order]
        n = np.bincount(code)
        ends = np.cumsum(n)
        steps = np.diff(place, prepend=0).astype(np.uint32)
        steps[ends - n] = place[ends - n]
        packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.r_[0, ends * 4].astype(np.int32)), pa.py_buffer(steps)])
        for s in range(0, len(n), 1 << 16):
            own = pa.array(n[s : s + (1 << 16)])
            none = pa.nulls(len(own), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), none, none, coded.dictionary.slice(s, len(own)), own, packed.slice(s, len(own))], names)


def positional_index(docs: DataFrame) -> DataFrame:
    """The index of frame (rid, text), written to the shared folder."""
    return written(docs.select("rid", "text").mapInArrow(_index, "block long, rid long, first long, term binary, n long, postings binary"))


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch["text"])
        words, counts = words_of(texts, WORD)
        found = words.to_pylist()
        item, out, at = [], [], 0
        for i, n in enumerate(counts.tolist()):
            own = found[at : at + n]
            at += n
            for k in range(max(1, n - size + 1) if n else 0):
                item.append(i)
                out.append(own[k : k + size])
        yield pa.RecordBatch.from_arrays([batch["item_id"].take(pa.array(item, pa.int64())), pa.array(out, pa.list_(pa.binary()))], ["item_id", "words"])


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, words): each run of ``size`` words of an item; a shorter item is one window, an
    item without words none."""
    return items.mapInArrow(lambda b: _windows(b, size), f"item_id {dict(items.dtypes)['item_id']}, words array<binary>")


def _starts(places: dict, words: list[tuple[int, bytes]], slop: int) -> np.ndarray:
    """Places at which a window stands, its words given rarest first as (offset, term)."""
    at, (k, term) = None, words[0]
    at = places[term] - k
    for k, term in words[1:]:
        other = places.get(term)
        if other is None or not len(at):
            return at[:0]
        i = np.searchsorted(other, at + k - slop)
        at = at[(i < len(other)) & (other[np.minimum(i, len(other) - 1)] <= at + k + slop)]
    return at


def _match(index: pa.Table, pairs: pa.Table, slop: int) -> pa.Table:
    """Per document of one block: words hit and windows found."""
    term, rid = index["term"].to_pylist(), index["rid"].to_pylist()
    first, n, packed = index["first"].to_pylist(), index["n"].to_pylist(), index["postings"].to_pylist()
    places = {t: np.cumsum(np.frombuffer(p, np.uint32).astype(np.int64)) for t, p in zip(term, packed) if t is not None}
    texts = sorted((f, r, m) for f, r, m, t in zip(first, rid, n, term) if t is None)
    start = np.array([f for f, _, _ in texts], np.int64)
    spans, found = {}, {}
    for window, words in zip(pairs["window"].to_pylist(), pairs["words"].to_pylist()):
        ordered = [(w["k"], w["term"]) for w in words]
        last = max(k for k, _ in ordered)
        for s in _starts(places, ordered, slop).tolist() if ordered[0][1] in places else ():
            d = int(np.searchsorted(start, max(s, 0), side="right")) - 1
            spans.setdefault(d, []).append((max(s, texts[d][0]), min(s + last + 1, texts[d][0] + texts[d][2])))
            found.setdefault(d, set()).add(window)
    rows = []
    for d, own in spans.items():
        covered, upto = 0, -1
        for a, b in sorted(own):
            covered += max(0, b - max(a, upto))
            upto = max(upto, b)
        rows.append((texts[d][1], covered, sorted(found[d])))
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int64()))], names=["rid", "n_hit", "windows"])


def contamination(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", size: int = WINDOW, slop: int = 0
) -> DataFrame:
    """One row per row of ``docs``: rid, its id, n_words, n_hit (words inside a found window) and
    ``items``, the sorted distinct ids of items with a found window.

    Words are lower-cased runs of ASCII letters, digits and anything beyond ASCII.  Null and
    empty texts have no words and are never hit; null and empty items have no window; items
    with equal texts are all found; a null item id is found (n_hit) but not listed.  Repeated
    rows are separate documents.  Either table may be empty.  Other columns are not read.
    """
    own = numbered(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    index = positional_index(own)
    listed = written(item_windows(items.select(F.col(item_column).alias("item_id"), F.col(item_text).alias("text")), size))
    windows = written(listed.select("words").distinct().withColumn("window", F.monotonically_increasing_id()))
    placed = windows.select("window", F.size("words").alias("size"), F.posexplode("words").alias("k", "term"))
    terms = placed.select("term").distinct()
    texts, lists = index.where("term is null"), index.where("term is not null").join(terms, "term", "left_semi")
    often = lists.groupBy("term").agg(F.sum("n").alias("often"))
    ordered = (
        placed.join(often, "term")
        .groupBy("window", "size")
        .agg(F.sort_array(F.collect_list(F.struct("often", "k", "term"))).alias("words"))
        .where("size(words) = size")
        .select("window", F.col("words")[0]["term"].alias("term"), "words")
    )
    pairs = ordered.join(lists.select("term", "block"), "term").select("block", "window", "words")
    held = texts.unionAll(lists.select(*texts.columns))
    hit = written(
        held.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(lambda a, b: _match(a, b, slop), "rid long, n_hit long, windows array<long>")
    )
    window_items = listed.join(windows, "words").select("window", "item_id").distinct()
    found = hit.select("rid", F.explode("windows").alias("window")).join(window_items, "window").groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    told = texts.select("rid", F.col("n").alias("n_words")).join(hit.select("rid", "n_hit"), "rid", "left").join(found, "rid", "left")
    item_type = dict(found.dtypes)["items"]
    return own.select("rid", "id").join(told, "rid").select(
        "rid", F.col("id").alias(id_column), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast(item_type)).alias("items")
    )
