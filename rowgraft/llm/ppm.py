"""Code length of texts under prediction by partial matching (PPM), learned from part of them.

The model predicts each byte of a text from the ``ORDER`` bytes before it.  Its trie is the table
of all byte strings of ORDER + 1 bytes in the training texts with their counts; shorter
contexts are its suffix sums.  A byte not seen after the longest context escapes to the next
shorter one (method D: half an occurrence of every different byte seen there is left to the
escape), and bytes already ruled out by longer contexts are excluded; below the empty context
all bytes left are equally likely.

A text is taken as its lower-cased words with one blank between them and an end mark, which is
also what stands before it; so its score is a probability of the same tokens that the word
baseline scores.

Texts never meet the whole model.  Neighbouring documents form blocks; a block asks for the
strings and words it holds, once each, packed by a hash of the key.  Per hash bucket the counts
of all blocks are summed; the strings, once each, go through the model; and the answers return
to the block in the order of its questions, so keys travel one way only.  The block, whose
texts know their keys, then scores them.  There are as many buckets as blocks, so that no
task holds more than a block's worth, and all that moves grows with the distinct strings of a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import NOT_BLANK, numbered, slices, words_of, written

ORDER = 5
#: Bits of a 64-bit key that a string leaves: room for a count or a text's number beside it, so that
#: one sort of the keys brings equal strings together and nothing else has to follow.
SPARE = np.uint64(64 - 8 * (ORDER + 1))
MOST = np.uint64((1 << int(SPARE)) - 1)
#: Documents of a block, as a power of two.
BLOCK_BITS = 13
LEAST_BUCKETS = 64
END = b"\n"


def tokens_text(text: bytes) -> bytes:
    """The text as the model reads it, after the marks that stand before it."""
    return END * ORDER + b" ".join(text.lower().split()) + END


def _laid(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts as the model reads them, end to end, and their sizes."""
    laid = [tokens_text(t) for t in texts]
    return b"".join(laid), np.fromiter(map(len, laid), np.int64, len(laid))


def _strings(laid: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The string of ORDER + 1 bytes that ends at each byte of the texts, its last byte lowest,
    and how many strings each text has."""
    packed, held = np.frombuffer(laid, np.uint8).astype(np.uint64), 1
    while held <= ORDER:  # those that lie ``more`` bytes before, over what both hold
        more = min(held, ORDER + 1 - held)
        packed[more:] |= packed[:-more] << np.uint64(8 * more)
        held += more
    begin = np.cumsum(size) - size
    inside = np.ones(len(packed), bool)
    for k in range(ORDER):
        inside[begin + k] = False
    return packed[inside], size - ORDER


def _first(ascending: np.ndarray) -> np.ndarray:
    """Where each distinct value of ascending ones begins."""
    new = np.ones(len(ascending), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    return np.flatnonzero(new)


def _distinct(grams: np.ndarray) -> np.ndarray:
    grams = np.sort(grams)
    return grams[_first(grams)]


def _with_counts(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Keys of strings and counts; a count too large for a key is told by several."""
    keys = grams << SPARE
    if len(n) and n.max() > MOST:
        keys = np.r_[keys | n % MOST, np.repeat(keys | MOST, (n // MOST).astype(np.int64))]
    else:
        keys |= n
    return keys


def _tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct strings of the keys, ascending, and their counts summed."""
    keys.sort()
    grams = keys >> SPARE
    first = _first(grams)
    return grams[first], np.add.reduceat(keys & MOST, first)


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (((grams * np.uint64(0xD1342543DE82EF95)) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _word_bucket(words: list[bytes], buckets: int) -> np.ndarray:
    return np.array([crc32(w) % buckets for w in words], np.int64)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in order) of each bucket that has any."""
    if len(bucket) and bucket.max() < 1 << 16:
        bucket = bucket.astype(np.uint16)  # numpy sorts these digit by digit
    order = np.argsort(bucket, kind="stable")
    for a, b in _runs(bucket[order]):
        yield int(bucket[order[a]]), order[a:b]


ASKED = "kind int, block long, bucket long, total long, grams binary, words array<binary>, n binary"
GRAMS, WORDS, PAIRS, STATS = range(4)


def _asked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Questions of each block by bucket: its distinct strings (ascending, as differences) or words
    (ascending) with their number in training texts.  Counts of two-byte strings come as rows."""
    names = ["kind", "block", "bucket", "total", "grams", "words", "n"]

    def rows(kind: int, block: int, bucket: list, total=None, grams=None, words=None, n=None) -> pa.RecordBatch:
        m = len(bucket)
        given = zip((total, grams, words, n), (pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * m, pa.int32()), pa.array([block] * m, pa.int64()), pa.array(bucket, pa.int64()), *[pa.nulls(m, t) if x is None else x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in given]], names
        )

    def told(block: int, parts: list) -> Iterator[pa.RecordBatch]:
        grams, n = _tallied(np.concatenate([k for k, _ in parts]))
        n = n.astype(np.uint32)
        pairs = np.bincount((grams & np.uint64(0xFFFF)).astype(np.int64), n, 1 << 16).astype(np.int64)
        code = np.flatnonzero(pairs)
        yield rows(PAIRS, block, code, total=pairs[code])
        dealt = list(_dealt(_bucket(grams, buckets)))
        yield rows(GRAMS, block, [k for k, _ in dealt], grams=[np.diff(grams[i], prepend=np.uint64(0)).tobytes() for _, i in dealt], n=[n[i].tobytes() for _, i in dealt])
        summed = pa.concat_tables([w for _, w in parts]).group_by("word").aggregate([("n", "sum")]).sort_by("word")
        words, n = summed["word"].combine_chunks(), summed["n_sum"].to_numpy().astype(np.uint32)
        dealt = list(_dealt(_word_bucket(words.to_pylist(), buckets)))
        if dealt:
            ends = np.cumsum([0, *[len(i) for _, i in dealt]])
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(np.concatenate([i for _, i in dealt]))))
            yield rows(WORDS, block, [k for k, _ in dealt], words=listed, n=[n[i].tobytes() for _, i in dealt])

    block, parts = None, []
    for batch, texts in slices(batches):
        learned, blocks = batch["learned"].to_numpy(zero_copy_only=False), batch["block"].to_numpy()
        for s, e in _runs(blocks):
            if blocks[s] != block and parts:
                yield from told(block, parts)
                parts = []
            block, own, counts = int(blocks[s]), texts[s:e], learned[s:e]
            grams, m = _strings(*_laid(own))
            seen = _tallied(_with_counts(grams, np.repeat(counts.astype(np.uint64), m)))
            words, each = words_of(own, NOT_BLANK)
            coded = words.dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), np.repeat(counts, each), len(coded.dictionary)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
            parts.append((_with_counts(*seen), pa.table([coded.dictionary, pa.array(n)], names=["word", "n"])))
    if parts:
        yield from told(block, parts)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return ((a, b) for a, b in zip(edges, edges[1:]) if a < b)


def _keys(packed: list[bytes]) -> list[np.ndarray]:
    return [np.cumsum(np.frombuffer(g, np.uint64), dtype=np.uint64) for g in packed]


def _sums(asked: pa.Table) -> pa.Table:
    """(gram, n) of one bucket over all blocks."""
    grams, at = np.unique(np.concatenate(_keys(asked["grams"].to_pylist())), return_inverse=True)
    n = np.bincount(at, np.concatenate([np.frombuffer(x, np.uint32) for x in asked["n"].to_pylist()])).astype(np.int64)
    return pa.table({"gram": grams.view(np.int64), "n": n})


def _answered(asked: pa.Table, model: pa.Table) -> pa.Table:
    order = np.argsort(model["gram"].to_numpy().view(np.uint64))
    grams, logp = model["gram"].to_numpy().view(np.uint64)[order], model["logp"].to_numpy()[order].astype(np.float32)
    found = [logp[np.searchsorted(grams, k)].tobytes() for k in _keys(asked["grams"].to_pylist())]
    return _answers(asked["block"].to_pylist(), asked["bucket"].to_pylist(), GRAMS, found)


def _answers(block: list, bucket: list, kind: int, found: list[bytes]) -> pa.Table:
    return pa.table([pa.array(block, pa.int64()), pa.array(bucket, pa.int64()), pa.array([kind] * len(found), pa.int32()), pa.array(found, pa.binary())], names=["block", "bucket", "kind", "found"])


def _totals(asked: pa.Table) -> pa.Table:
    """Answers for the words of one bucket, and a row that holds, as bucket and block, how many
    distinct and how many training words there are."""
    words = asked["words"].combine_chunks()
    code = words.flatten().dictionary_encode().indices.to_numpy()
    total = np.bincount(code, np.concatenate([np.frombuffer(x, np.uint32) for x in asked["n"].to_pylist()])).astype(np.uint32)
    ends = np.cumsum(words.value_lengths().to_numpy())
    found = [total[code[e - m : e]].tobytes() for e, m in zip(ends.tolist(), words.value_lengths().to_pylist())]
    stats = _answers([int(total.sum(dtype=np.int64))], [int(np.count_nonzero(total))], STATS, [None])
    return pa.concat_tables([_answers(asked["block"].to_pylist(), asked["bucket"].to_pylist(), WORDS, found), stats])


def log_probabilities(grams: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the last byte's probability after the bytes before it, for each string.

    ``n`` are the strings' counts, 0 for strings to be predicted only.  All strings of one
    two-byte context must be there; ``pairs`` (256 x 256) counts what follows single bytes.
    """
    grams = grams.view(np.uint64)
    last, before = (grams & np.uint64(0xFF)).astype(np.int64), ((grams >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
    single = pairs.sum(axis=0)
    # Per string and order: count of the string, of its context, of different bytes after the
    # context, and what these bytes count one order below.
    own, total, kinds, below = [single[last]], [np.full(len(grams), single.sum())], [np.full(len(grams), np.count_nonzero(single))], [np.zeros(len(grams), np.int64)]
    own.append(pairs[before, last])
    total.append(pairs.sum(axis=1)[before])
    kinds.append((pairs > 0).sum(axis=1)[before])
    below.append(np.where(pairs > 0, single, 0).sum(axis=1)[before])
    for k in range(2, ORDER + 1):
        key, first, at = np.unique(grams & np.uint64((1 << 8 * (k + 1)) - 1), return_index=True, return_inverse=True)
        count = np.bincount(at, n)
        _, after = np.unique(key >> np.uint64(8), return_inverse=True)
        shorter = np.where(count > 0, own[k - 1][first], 0)
        own.append(count[at].astype(np.int64))
        total.append(np.bincount(after, count)[after][at].astype(np.int64))
        kinds.append(np.bincount(after, count > 0)[after][at].astype(np.int64))
        below.append(np.bincount(after, shorter)[after][at].astype(np.int64))
    found = np.zeros(len(grams))
    open_ = np.ones(len(grams), bool)
    ruled, ruled_kinds = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
    with np.errstate(divide="ignore"):
        for k in range(ORDER, -1, -1):
            new = kinds[k] - ruled_kinds
            whole = total[k] - ruled
            hit = open_ & (own[k] > 0)
            found[hit] += np.log10((own[k][hit] - 0.5) / whole[hit])
            open_ &= ~hit
            escaped = open_ & (new > 0)
            found[escaped] += np.log10(0.5 * new[escaped] / whole[escaped])
            ruled, ruled_kinds = below[k], kinds[k]
    found[open_] -= np.log10(256 - kinds[0][open_])
    return found


def _predict(group: pa.Table, pairs: np.ndarray, buckets: int) -> pa.Table:
    grams = group["gram"].to_numpy()
    return pa.table({"gram": grams, "bucket": _bucket(grams.view(np.uint64), buckets), "logp": log_probabilities(grams, group["n"].to_numpy(), pairs)})


def _put_back(bucket: np.ndarray, answers: dict[int, bytes], kind) -> np.ndarray:
    """Answers in the order of the keys, which were asked bucket by bucket."""
    values = np.zeros(len(bucket), kind)
    for k, at in _dealt(bucket):
        values[at] = np.frombuffer(answers[k], kind)
    return values


def _score(docs: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    """Per document of a block: tokens, known ones, the sum of log10(c + 0.5) over its words and
    log10 of the model's probability."""
    told: dict[int, dict[int, bytes]] = {GRAMS: {}, WORDS: {}}
    for kind, bucket, found in zip(*(answers[c].to_pylist() for c in ("kind", "bucket", "found"))):
        told[kind][bucket] = found
    seen, listed, held = [], [], []
    for batch, texts in slices(iter(docs.to_batches())):
        laid, size = _laid(texts)
        seen.append(_distinct(_strings(laid, size)[0]))
        words, each = words_of(texts, NOT_BLANK)
        coded = words.dictionary_encode()
        listed.append(coded.dictionary)
        held.append((batch["rid"].to_numpy(), laid, size, coded.indices.to_numpy(), each))
    grams, words = _distinct(np.concatenate(seen)), pa.concat_arrays(listed).dictionary_encode()
    logp = _put_back(_bucket(grams, buckets), told[GRAMS], np.float32)
    order = pc.sort_indices(words.dictionary)
    counts = np.zeros(len(order), np.uint32)
    counts[order.to_numpy()] = _put_back(_word_bucket(words.dictionary.take(order).to_pylist(), buckets), told[WORDS], np.uint32)
    known, logs = counts > 0, np.log10(counts + 0.5)
    codes, out = np.split(words.indices.to_numpy(), np.cumsum([len(x) for x in listed])[:-1]), []
    for (rid, laid, size, coded, each), code in zip(held, codes):
        own, m = _strings(laid, size)
        keys = own << SPARE | np.repeat(np.arange(len(size), dtype=np.uint64), m)  # a block's texts fit beside the string
        keys.sort()
        own = keys >> SPARE
        first = _first(own)
        found = np.repeat(logp[np.searchsorted(grams, own[first])], np.diff(np.r_[first, len(own)]))
        score = np.bincount((keys & MOST).astype(np.int64), found, len(size))
        code, text = code[coded], np.repeat(np.arange(len(size)), each)
        out.append((rid, each.astype(np.int64), np.bincount(text, known[code], len(size)).astype(np.int64), np.bincount(text, logs[code], len(size)).astype(float), score))
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], names=["rid", "n_words", "n_known", "words_log", "score"])


def lm_scores(docs: DataFrame, learned: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: rid, its id, n_tokens, n_known, train_tokens, base_score, score.

    ``learned`` is a condition on the columns of ``docs``: the rows the model and the word counts
    learn from (null: no).  Tokens are the lower-cased words and one end.  A null or empty text
    is just the end.  Repeated rows are learned as often as they occur.  Without training texts
    every byte has probability 1/256 and every token the same base.  An empty table gives no
    rows.  Other columns are not read.
    """
    own = numbered(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.coalesce(learned, F.lit(False)).alias("learned")))
    own = own.withColumn("block", F.shiftright("rid", BLOCK_BITS))
    texts = own.select("rid", "block", "text")
    ends = own.where("learned").count()
    buckets = max(LEAST_BUCKETS, own.count() >> BLOCK_BITS)
    asked = written(own.select("block", "text", "learned").mapInArrow(lambda b: _asked(b, buckets), ASKED))
    pairs = np.zeros((256, 256), np.int64)
    for row in asked.where(F.col("kind") == PAIRS).groupBy("bucket").agg(F.sum("total").alias("n")).collect():  # 65,536 rows at most
        pairs[divmod(row.bucket, 256)] = row.n
    grams = asked.where(F.col("kind") == GRAMS).select("bucket", "block", "grams", "n")
    model = grams.groupBy("bucket").applyInArrow(_sums, "gram long, n long")
    model = model.withColumn("context", F.expr("pmod(hash((gram div 256) % 65536), 256)")).groupBy("context").applyInArrow(lambda t: _predict(t, pairs, buckets), "gram long, bucket long, logp double")
    answer = "block long, bucket long, kind int, found binary"
    to_grams = grams.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(_answered, answer)
    words = written(asked.where(F.col("kind") == WORDS).select("bucket", "block", "words", "n").groupBy("bucket").applyInArrow(_totals, answer))
    kinds, seen = words.where(F.col("kind") == STATS).agg(F.coalesce(F.sum("bucket"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    to_words = words.where(F.col("kind") == WORDS)
    schema = "rid long, n_words long, n_known long, words_log double, score double"
    scored = texts.groupBy("block").cogroup(to_grams.unionAll(to_words).groupBy("block")).applyInArrow(lambda d, a: _score(d, a, buckets), schema)
    total, kinds = seen + ends, kinds + (ends > 0)
    per_token = F.log10(F.lit(total + 0.5 * (kinds + 1)))
    n_tokens = F.col("n_words") + 1
    return (
        own.select("rid", "id")
        .join(scored, "rid")
        .select(
            "rid",
            F.col("id").alias(id_column),
            n_tokens.alias("n_tokens"),
            (F.col("n_known") + int(ends > 0)).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("words_log") + F.log10(F.lit(ends + 0.5)) - n_tokens * per_token).alias("base_score"),
            "score",
        )
    )
