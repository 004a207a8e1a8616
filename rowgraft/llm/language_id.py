"""Language of a text by unigram pieces with all segmentations summed.

Every language has a probability per piece of a fixed public vocabulary.  A text's probability
in a language is the sum over all its segmentations, by the forward algorithm.  The piece
probabilities are learned from a bounded sample of labelled texts (about ``per_language`` of each
language, those with the least hash in each of ``SALTS`` shares) by one step of expectation maximisation:
the expected number of times each piece is used, over all segmentations weighted by a common
prior, summed per language.  Only (language, piece) sums travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import free_name, numbered, slices
from rowgraft.llm.lattice import CHUNK, LEAST, MODEL, Lattice, Segments, Vocabulary, load_vocabulary, zipf

UNKNOWN = "und"
#: Added to every expected count.
SMOOTHING = 0.1
#: Texts of each language to learn from: so many at most, and a SALTS-th of them, rounded up, from
#: each share of its rows.
PER_LANGUAGE = 1024
SALTS = 64


def _expected(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """(lang, piece, expected uses) of a task, summed before they travel."""
    prior, sums = zipf(vocabulary), {}
    for batch, texts in slices(batches, most=CHUNK):
        langs, cut = batch["lang"].to_pylist(), Segments(texts)
        lattice = Lattice(vocabulary, cut.distinct)
        ahead, behind = lattice.forward(prior[None])[0], lattice.backward(prior[None])[0]
        owner = lattice.owner[lattice.start]
        used = np.exp(ahead[lattice.start] + prior[lattice.piece] + behind[lattice.end] - behind[lattice.base][owner])
        for lang in sorted(set(langs)):
            own = np.array([x == lang for x in langs])
            times = np.bincount(cut.code[own[cut.text]], minlength=len(cut.distinct))
            sums[lang] = sums.get(lang, 0) + np.bincount(lattice.piece, used * times[owner], vocabulary.size)
    for lang, found in sums.items():
        piece = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(piece)), pa.array(piece), pa.array(found[piece])], ["lang", "piece", "uses"])


def learn(labelled: DataFrame, lang_column: str = "lang", text_column: str = "text", per_language: int = PER_LANGUAGE, model: str = MODEL) -> tuple[list[str], np.ndarray]:
    """(languages in order, log probability by language and piece).

    The rows with a language and a text are sampled down to ``per_language`` of each language
    (rounded up to a multiple of ``SALTS``).
    An empty table, or one without languages, teaches nothing.

    The sums per language and piece reach the driver: at most the vocabulary's size for each language.
    """
    vocabulary = load_vocabulary(model)
    own = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where("lang is not null and text is not null")
    own = numbered(own)
    # Copies of a text differ in their row number, so they do not enter together, and a language
    # that most rows have is ranked in shares.
    hashed = own.select("rid", "lang", F.xxhash64("text", "rid").alias("h")).withColumn("nth", F.expr(f"row_number() over (partition by lang, pmod(h, {SALTS}) order by h, rid)"))
    # A bounded number of row numbers, whatever the size of the table.
    sample = F.broadcast(hashed.where(F.col("nth") <= -(-per_language // SALTS)).select("rid"))
    rows = own.join(sample, "rid", "left_semi").select("lang", "text").mapInArrow(lambda b: _expected(b, vocabulary), "lang string, piece long, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.full((len(langs), vocabulary.size), SMOOTHING)
    for k, lang in enumerate(langs):
        of = rows[rows["lang"] == lang]
        counts[k, of["piece"].to_numpy()] += of["uses"].to_numpy()
    return langs, np.maximum(np.log(counts / counts.sum(axis=1, keepdims=True)), LEAST)


class Likelihoods:
    """log probability of texts in each language; segments met before are looked up."""

    #: Distinct segments that are kept.
    MOST = 1 << 17

    def __init__(self, vocabulary: Vocabulary, weight: np.ndarray):
        self.vocabulary, self.weight = vocabulary, weight
        self.known, self.value = pa.array([], pa.binary()), np.zeros((0, len(weight)))

    def of_segments(self, distinct: pa.Array) -> np.ndarray:
        at = pc.fill_null(pc.index_in(distinct, self.known), -1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(at < 0)
        found = np.empty((len(distinct), len(self.weight)))
        found[at >= 0] = self.value[at[at >= 0]]
        fresh = distinct.take(pa.array(new))
        lattice = Lattice(self.vocabulary, fresh)
        found[new] = lattice.forward(self.weight)[:, lattice.last].T
        if len(self.known) + len(new) > self.MOST:
            self.known, self.value = fresh, found[new]
        else:
            self.known, self.value = pa.concat_arrays([self.known, fresh]), np.concatenate([self.value, found[new]])
        return found

    def of(self, texts: list[bytes]) -> np.ndarray:
        cut = Segments(texts)
        each = self.of_segments(cut.distinct)
        return np.stack([np.add.reduceat(e[cut.code], cut.first) for e in each.T], 1)


def with_language(docs: DataFrame, learned: tuple[list[str], np.ndarray], text_column: str = "text", model: str = MODEL) -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` (its posterior among the languages, all equally
    likely beforehand; ties go to the first name).

    A null or empty text, or one without a letter, is ``und`` with score 0, as is any text when
    nothing was learned.  Rows do not influence each other.  Columns of ``docs`` with these names
    keep them; the new ones get a trailing underscore.
    """
    langs, weight = learned
    vocabulary = load_vocabulary(model)
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of = Likelihoods(vocabulary, weight)
        for batch, texts in slices(batches, text_column, CHUNK):
            names, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            told = np.array([any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts], bool)
            at = np.flatnonzero(told)
            if langs and len(at):
                seen = model_of.of([texts[i] for i in at])
                best = seen.argmax(axis=1)
                share = 1 / np.exp(seen - seen.max(axis=1, keepdims=True)).sum(axis=1)
                for i, k, s in zip(at.tolist(), best.tolist(), share.tolist()):
                    names[i], scores[i] = langs[k], s
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, pred, score])

    schema = docs.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score)).schema
    return docs.mapInArrow(run, schema)


def rejected(pred: Column, score: Column, least: float = 0.5) -> Column:
    """No language, or none that is likelier than all others together."""
    return (pred == UNKNOWN) | (score < least)
