"""The prefix trie against a walk over all conversations."""

import collections
import hashlib
import zlib

import pytest

from rowgraft.llm import prefix_trie


def _trie(turns, every=20, deepest=4):
    own = collections.defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % deepest
        whole[c] = own.get(c - int(c % every if c >= 0 else -(-c % every)), [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    out = set()
    for key, ids in members.items():
        below = [k for k in members if k[: len(key)] == key]
        inner = {k[:-1] for k in members if k}
        saved = sum((len(members[k]) - 1) * len(k[-1][1].split()) for k in below if k)
        ends = ",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(key))
        row = (min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids), sum(len(k) == len(key) + 1 for k in below), sum(k not in inner for k in below), saved)
        out.add((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return out


TURNS = (
    [(c, k, "user" if k % 2 == 0 else None, f"turn {k} of {c % 3 if c > 40 else 'all'}" if k != 3 else None) for c in range(10, 90) for k in range(c % 6 + 1)]
    + [(300 + c, k, "user", f"hot {k}") for c in range(60) for k in range(5)]
    + [(-7, None, "user", "first, without a turn"), (-7, 0, "user", "a b  c\td"), (-7, 1, "", ""), (0, 1, "user", "x"), (None, 1, "user", "nobody's"), (1000, 1, "user", "z"), (1001, 1, "user", None)]
    + [(2000, k, "user", f"long {k // 2}") for k in range(40)] + [(2020, k, "user", f"long {k // 2}") for k in range(30)]
)


@pytest.mark.parametrize(("block", "deepest"), [(4096, 4), (4, 4), (4, 1)])
def test_trie(spark, block, deepest, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "ENDS", block)
    frame = spark.createDataFrame([(*t, "x", 1) for t in TURNS], "conv_id long, turn int, role string, text string, depth string, words int").repartition(4, "text").cache()
    rows, convs = prefix_trie.rebuilt(prefix_trie.turn_hashes(frame), deepest=deepest)
    got = prefix_trie.prefix_trie(rows, convs)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == _trie(TURNS, deepest=deepest)


def test_turns_that_share_a_place(spark):
    turns = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 1, "user", "a"), (2, 1, "user", "b"), (2, 1, "user", "a")]
    rows, convs = prefix_trie.rebuilt(prefix_trie.turn_hashes(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")), deepest=1)
    got = prefix_trie.prefix_trie(rows, convs).collect()
    assert sorted(r.depth for r in got) == [0, 1, 2, 3] and {r.n_convs for r in got} == {2}
    nothing = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert prefix_trie.prefix_trie(*prefix_trie.rebuilt(prefix_trie.turn_hashes(nothing))).count() == 0
