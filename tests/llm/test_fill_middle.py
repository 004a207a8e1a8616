"""Fill-in-the-middle texts against cuts by lists of units."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from rowgraft.llm import fill_middle

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def _expected(key, text, rate=50, suffix_first=80):
    text = text or ""
    u = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_outputs(spark):
    rng = random.Random(3)
    some = ["".join(rng.choice(["a", "bé", "😀", " ", "\n", "\t", "\x1c", " ", "word", "<", "P>"]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts = [*some, None, "", "  ", "x", " x ", "<S>", "a <M> b", "w " * 60000, "y" * 100000, "same", "same"]
    rows = [(None if i == 5 else i - i % 2 * (i > 408), t, "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string").repartition(3, "doc_id")
    out = fill_middle.fill_in_middle(docs, rate=90).withColumn("again", fill_middle.restored(F.col("output"), F.col("form_")))
    assert out.columns == ["doc_id", "text", "form", "n_units", "form_", "prefix_chars", "middle_chars", "output", "again"]
    got = out.collect()
    assert len(got) == len(rows) and {r["form_"] for r in got} == {"plain", "spm", "psm"}
    for r in got:
        assert (r.n_units, r["form_"], r.prefix_chars, r.middle_chars, r.output) == _expected(r.doc_id, r.text, 90)
        assert r.again == (r.text or "") and r.form == "kept"
    assert fill_middle.fill_in_middle(docs.where("1 = 0")).count() == 0


def test_skip_lists_reach_every_rank():
    rng = np.random.default_rng(2)
    units = np.array([0, 1, 7, 300, 0, 5000])
    lengths = [rng.integers(1, 9, n) for n in units]
    lists = fill_middle.SkipLists(units, np.concatenate([np.cumsum(x) for x in lengths]))
    assert 4 <= len(lists.lanes) <= 9 and all(len(a[0]) > len(b[0]) for a, b in zip(lists.lanes, lists.lanes[1:]))
    for share in np.linspace(0, 1, 60):
        ranks = (units * share).astype(int)
        assert lists.seek(ranks).tolist() == [int(x[:r].sum()) for x, r in zip(lengths, ranks)]
