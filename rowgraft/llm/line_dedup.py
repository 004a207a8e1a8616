"""Repeated lines and sentences go, the earliest stays, and offsets into the original text are kept.

Units (lines, cut at sentence ends) are normalised and digested where the text lies, once; only
(digest, rank, offsets) are written and travel.  Digests are grouped globally with partial sums,
so a unit that a third of the documents have travels as one row per task, and only digests that
occur twice are joined back to the units.

Beside the removal each document tells its longest stretch of neighbouring units that occur
elsewhere too, which is how a copied passage shows although it begins and ends inside a unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowgraft.llm.common import durable, numbered

#: Words of neighbouring repeated units that make a passage.  One of over 50 words keeps about so
#: many when the units it begins and ends in are cut off.
PASSAGE = 40
#: A unit ends behind a sentence (blanks after it included) and before a line end.
UNIT_END = "[.!?]+[ \t]+|[。！？]+|\n"
_UNIT_END, _BLANKS = re.compile(UNIT_END), re.compile(r"[ \t\r\f\v]+")
UNITS = "id {id}, rid long, nth int, start int, size int, words int, h1 long, h2 long"


def normal(unit: str) -> str:
    return _BLANKS.sub(" ", unit.lower()).strip(" ")


def units_of(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each unit, empty ones included; line ends belong to none."""
    at = 0
    for m in _UNIT_END.finditer(text):
        line = m.group() == "\n"
        yield at, m.start() if line else m.end()
        at = m.end()
    yield at, len(text)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, nth, start, size, words, digests = [], [], [], [], [], []
        for i, text in enumerate(batch["text"].to_pylist()):
            k, text = 0, text or ""
            for a, b in units_of(text):
                plain = normal(text[a:b])
                if plain:
                    row.append(i)
                    nth.append(k)
                    start.append(a)
                    size.append(b - a)
                    words.append(plain.count(" ") + 1)
                    digests.append(xxhash.xxh3_128_digest(plain.encode()))
                    k += 1
        h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        own = pa.array(row, pa.int64())
        ints = [pa.array(x, pa.int32()) for x in (nth, start, size, words)]
        yield pa.RecordBatch.from_arrays([batch["id"].take(own), batch["rid"].take(own), *ints, pa.array(h[:, 0]), pa.array(h[:, 1])], ["id", "rid", "nth", "start", "size", "words", "h1", "h2"])


def repeated_units(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: rid, its id, ``n_units``, ``spans``: the units to be removed as
    character offsets (start, end) in order, and ``passage_words``, the words of its longest
    stretch of neighbouring units that occur more than once anywhere, earliest ones included.

    The earliest occurrence in order of (id, nulls last; row number; place) stays, also within
    one text.  Every unit with a character that is no blank counts, however short.  Null and
    empty texts have no units.  Rows with equal ids are told apart by their row number.  Nothing
    is assumed about other columns, and an empty table gives no rows.
    """
    own = numbered(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    units = durable(own.mapInArrow(_units, UNITS.format(id=dict(own.dtypes)["id"])))
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("rid"), F.col("nth"))
    first = units.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that the join reads two plain exchanges and a very common unit is split there.
    first = durable(first.select("h1", "h2", F.col("first.rid").alias("first_rid"), F.col("first.nth").alias("first_nth")))
    again = units.drop("id").join(first, ["h1", "h2"])
    found = again.select("rid", F.struct("nth", "start", (F.col("start") + F.col("size")).alias("end"), "words", F.expr("rid <> first_rid or nth <> first_nth").alias("gone")).alias("unit"))
    counted = units.groupBy("rid").agg(F.count(F.lit(1)).alias("n_units"))
    listed = found.groupBy("rid").agg(F.sort_array(F.collect_list("unit")).alias("units"))
    spans = F.transform(F.filter("units", lambda u: u["gone"]), lambda u: F.struct(u["start"].cast("long").alias("start"), u["end"].cast("long").alias("end")))
    zero = F.lit(0).cast("long")
    run = lambda s, u: F.when(u["nth"] == s["last"] + 1, s["run"]).otherwise(zero) + u["words"]
    stretch = F.aggregate(
        "units",
        F.struct(F.lit(-2).alias("last"), zero.alias("run"), zero.alias("best")),
        lambda s, u: F.struct(u["nth"].alias("last"), run(s, u).alias("run"), F.greatest(s["best"], run(s, u)).alias("best")),
        lambda s: s["best"],
    )
    told = listed.select("rid", spans.alias("spans"), stretch.alias("passage_words"))
    joined = own.select("rid", "id").join(counted, "rid", "left").join(told, "rid", "left")
    none = F.array().cast("array<struct<start:long,end:long>>")
    return joined.select("rid", F.col("id").alias(id_column), F.coalesce("n_units", zero).alias("n_units"), F.coalesce("spans", none).alias("spans"), F.coalesce("passage_words", zero).alias("passage_words"))


@F.pandas_udf(StringType())
def without_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text without these units, and without the line ends of lines that nothing is left of."""

    def cut(t, s):
        kept, at = "", 0
        for x in s if s is not None else ():
            kept += t[at : x["start"]]
            at = x["end"]
            if t[at : at + 1] == "\n" and kept[-1:] in ("", "\n"):
                at += 1
        return kept + t[at:]

    return pd.Series([None if t is None else cut(t, s) for t, s in zip(text, spans)])


def spans_text(spans: Column) -> Column:
    """Spans as "start-end,start-end"."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
