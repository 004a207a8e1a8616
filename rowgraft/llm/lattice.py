"""All segmentations of a text into pieces of a fixed vocabulary, for many texts at once.

Pieces hold blanks only at their front, so a text falls into segments (a run of blanks and the
run of other bytes after it) that are segmented independently.  Each distinct segment of a
chunk is laid out once: a node per byte boundary, an arc per piece that fits.  Sums over all
segmentations go through the nodes by their distance from the segment's start, all segments
side by side, so the number of array steps is the longest segment and not the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

#: Where the public tokenizers' files lie; a parameter of every operator that reads one.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text whose segments are laid out together.
CHUNK = 1 << 20
BLANK = 0x20
#: Stands for the end of a segment among bytes.
NONE = 256
#: Bytes of a segment whose probability can be multiplied out: pieces are likelier than 1e-9.
SHORT = 32
LEAST = np.log(1e-9)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes with blanks for the word mark, and a trie of them as a hash table of edges.

    ``first`` and ``second`` hold the first two levels of the trie densely; node 0 is its root and,
    as no edge leads there, stands for no node.  ``bytes_of[i]`` is what id i stands for (empty: a control id); ``byte_id[b]`` is the id used
    for byte b where no piece is the byte itself.
    """

    bytes_of: list[bytes]
    rank: np.ndarray
    byte_id: np.ndarray
    edge: np.ndarray
    child: np.ndarray
    slots: np.ndarray
    first: np.ndarray
    second: np.ndarray
    piece_at: np.ndarray
    longest: int

    @property
    def size(self) -> int:
        return len(self.bytes_of)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Trie nodes one byte on; 0 where there is none."""
        key = node.astype(np.int64) * 512 + byte
        mask = len(self.slots) - 1
        slot = _mixed(key) & mask
        at = self.slots[slot]
        wrong = np.flatnonzero(self.edge[at] != key)
        while len(wrong := wrong[at[wrong] >= 0]):
            slot[wrong] = (slot[wrong] + 1) & mask
            at[wrong] = self.slots[slot[wrong]]
            wrong = wrong[self.edge[at[wrong]] != key[wrong]]
        return np.where(at >= 0, self.child[at], 0)


def _mixed(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Reads a SentencePiece model file on the driver; its size is fixed by the file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    bytes_of, byte_id, edges, piece_at = [b""] * n, np.full(256, -1), {}, {}
    rank = np.arange(n)
    for b in range(256):  # so that the first level's nodes have the lowest numbers
        edges[b] = b + 1
    for i in range(n):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:5], 16)
            bytes_of[i], byte_id[value] = bytes([value]), i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            bytes_of[i] = model.id_to_piece(i).replace("▁", " ").encode()
            node = 0
            for b in bytes_of[i]:
                node = edges.setdefault(node * 512 + b, len(edges) + 1)
            piece_at.setdefault(node, i)
    edge, child = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32)
    first = np.zeros(NONE + 1, np.int32)
    top = edge < 512
    first[edge[top]] = child[top]
    second = np.zeros((int(first.max()) + 1, NONE + 1), np.int32)
    slots = np.full(1 << int(len(edge) * 3).bit_length(), -1, np.int32)
    todo, slot = np.arange(len(edge), dtype=np.int32), _mixed(edge) & (len(slots) - 1)
    while len(todo):
        free = slots[slot] < 0
        slots[slot[free]] = todo[free]
        out = slots[slot] != todo
        todo, slot = todo[out], (slot[out] + 1) & (len(slots) - 1)
    at = np.full(len(edge) + 1, -1, np.int32)
    for node, i in piece_at.items():
        at[node] = i
    under = np.isin(edge // 512, first[first > 0])
    second[edge[under] // 512, edge[under] % 512] = child[under]
    return Vocabulary(bytes_of, rank, byte_id, edge, child, slots, first, second, at, max(map(len, bytes_of)))


def zipf(vocabulary: Vocabulary) -> np.ndarray:
    """Log probability of each id by its place in the vocabulary (Zipf); byte ids count as last."""
    place = vocabulary.rank.astype(float)
    place[vocabulary.byte_id[vocabulary.byte_id >= 0]] = vocabulary.size
    weight = 1 / (place + 2.7)
    return np.log(weight / weight.sum())


class Segments:
    """Segments of texts, each text with a blank put before it, and the distinct ones."""

    def __init__(self, texts: list[bytes]):
        self.data = b"".join(b" " + t for t in texts)
        data = np.frombuffer(self.data, np.uint8)
        size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_start = np.cumsum(size) - size
        begins = np.zeros(len(data), bool)
        begins[1:] = (data[1:] == BLANK) & (data[:-1] != BLANK)
        begins[self.text_start] = True
        self.start = np.flatnonzero(begins)
        offsets = np.r_[self.start, len(data)].astype(np.int32)
        held = pa.Array.from_buffers(pa.binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = held.dictionary_encode()
        self.code = coded.indices.to_numpy()
        self.distinct = coded.dictionary
        self.first = np.searchsorted(self.start, self.text_start)
        self.text = np.repeat(np.arange(len(texts)), np.diff(np.r_[self.first, len(self.start)]))


class Lattice:
    """Arcs of all segmentations of distinct segments, ordered by their end node.

    Node ``base[s] + k`` is the place after k bytes of segment s.
    """

    def __init__(self, vocabulary: Vocabulary, segments: pa.Array):
        size = pc.binary_length(segments).to_numpy().astype(np.int64)
        self.base = np.cumsum(size + 1) - size - 1
        self.size, self.nodes, self.last = size, int((size + 1).sum()), self.base + size
        self.owner = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)
        # The byte after each node; the last node of a segment has none, which no piece goes on with.
        byte, inside = np.full(self.nodes, NONE, np.int32), np.ones(self.nodes, bool)
        inside[self.last] = False
        byte[inside] = np.frombuffer(b"".join(segments.to_pylist()), np.uint8)
        begin = np.arange(self.nodes, dtype=np.int32)
        state = vocabulary.first[byte]
        bare = inside & (vocabulary.piece_at[state] < 0)
        start, end, piece = [], [], []
        for k in range(1, vocabulary.longest + 1):
            live = state > 0
            state, begin = state[live], begin[live]
            if not len(begin):
                break
            found = vocabulary.piece_at[state]
            fits = found >= 0
            from_ = begin[fits]
            start.append(from_)
            end.append(from_ + np.int32(k))
            piece.append(found[fits])
            state = vocabulary.second[state, byte[begin + 1]] if k == 1 else vocabulary.step(state, byte[begin + k])
        at = np.flatnonzero(bare).astype(np.int32)
        start.append(at)
        end.append(at + np.int32(1))
        piece.append(vocabulary.byte_id[byte[at]].astype(np.int32))
        start, end, piece = (np.concatenate(x) for x in (start, end, piece))
        order = np.argsort(end, kind="stable")
        self.start, self.end, self.piece = start[order], end[order], piece[order]

    def _sum(self, weight: np.ndarray, into: np.ndarray, out: np.ndarray, distance: np.ndarray, begin: np.ndarray, long: np.ndarray) -> np.ndarray:
        """log of the summed weight of all paths from the ``begin`` nodes, per column and node.

        Sums of short segments cannot underflow and are made without logarithms; nodes of
        ``long`` segments are done again with them.  ``into`` ascends.
        """
        far = distance[into]
        order = np.argsort(far.astype(np.uint16) if len(far) and far.max() < 1 << 16 else far, kind="stable")
        into, out, piece, far = into[order], out[order], self.piece[order], far[order]
        with np.errstate(divide="ignore"):
            total = np.log(_paths(np.exp(weight)[:, piece], into, out, far, begin, self.nodes, False))
        arcs = long[into]
        if arcs.any():
            logs = _paths(weight[:, piece[arcs]], into[arcs], out[arcs], far[arcs], begin, self.nodes, True)
            total[:, long] = logs[:, long]
        return total

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Per column and node, log of the summed probability of all ways to reach it.
        ``weight``: log probability by column and id."""
        return self._sum(weight, self.end, self.start, np.arange(self.nodes) - self.base[self.owner], self.base, (self.size > SHORT)[self.owner])

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """Per column and node, the same for all ways from it to the segment's end."""
        order = np.argsort(self.start, kind="stable")
        turned = object.__new__(Lattice)
        turned.piece, turned.nodes = self.piece[order], self.nodes
        return turned._sum(weight, self.start[order], self.end[order], self.last[self.owner] - np.arange(self.nodes), self.last, (self.size > SHORT)[self.owner])


def _paths(weight: np.ndarray, into: np.ndarray, out: np.ndarray, far: np.ndarray, begin: np.ndarray, nodes: int, logs: bool) -> np.ndarray:
    """Sums over paths, arcs ordered by distance and node; weights and sums are logarithms if ``logs``."""
    total = np.full((len(weight), nodes), -np.inf if logs else 0.0)
    total[:, begin] = 0 if logs else 1
    edges = np.r_[0, np.flatnonzero(np.diff(into)) + 1] if len(into) else np.zeros(0, np.int64)
    step = np.r_[0, np.flatnonzero(np.diff(far)) + 1, len(into)] if len(into) else np.zeros(1, np.int64)
    at = np.searchsorted(edges, step)
    for a, b, i, j in zip(step[:-1].tolist(), step[1:].tolist(), at[:-1].tolist(), at[1:].tolist()):
        edge = edges[i:j] - a
        node = into[edges[i:j]]
        for column, own in zip(total, weight):
            if logs:
                value = column[out[a:b]] + own[a:b]
                top = np.maximum.reduceat(value, edge)
                each = np.diff(np.r_[edge, b - a])
                column[node] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, each)), edge))
            else:
                column[node] = np.add.reduceat(column[out[a:b]] * own[a:b], edge)
    return total
