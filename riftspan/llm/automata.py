"""Weighted acyclic automata over word numbers: sequences of one length with a count each.

An automaton has one layer of states per position. It is built from sorted sequences: a state is a common
beginning, an arc leads to the beginning that is one word longer. Counts are pushed towards the start, as far as all
continuations of a state share them, so that from the last layer up states with the same arcs become one. The count of a
sequence is the sum along its path.
"""

from __future__ import annotations

import numpy as np
import zstandard

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def grouped(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows and the sums of their counts."""
    if not len(rows):
        return rows, counts
    bits = max(1, int(rows.max()).bit_length())
    per_key = max(1, 63 // bits)
    keys = []
    for first in range(0, rows.shape[1], per_key):
        key = np.zeros(len(rows), np.int64)
        for column in range(first, min(first + per_key, rows.shape[1])):
            key = key << bits | rows[:, column]
        keys.append(key)
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    return rows[order[starts]], np.add.reduceat(counts[order], starts)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of spans, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _merge(starts: np.ndarray, labels: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each state (a span of arcs) the first state with exactly the same arcs."""
    degrees = np.diff(starts, append=len(labels))
    place = np.arange(len(labels)) - np.repeat(starts, degrees)
    mixed = np.zeros(len(labels), np.uint64)
    for part, multiplier in zip((labels, targets, weights, place), _MULTIPLIERS):
        mixed = (mixed ^ part.astype(np.uint64)) * multiplier
        mixed ^= mixed >> np.uint64(31)
    _, first, inverse = np.unique(np.add.reduceat(mixed, starts), return_index=True, return_inverse=True)
    like = first[inverse]
    differs = degrees != degrees[like]
    other = np.minimum(np.repeat(starts[like], degrees) + place, len(labels) - 1)
    unequal = (labels != labels[other]) | (targets != targets[other]) | (weights != weights[other])
    differs |= np.logical_or.reduceat(unequal, starts)
    return np.where(differs, np.arange(len(starts)), like)  # unequal arcs of equal hash stay apart


class CountAutomaton:
    """A set of sequences of ``depth`` word numbers with their counts."""

    def __init__(self, start: int, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.start = start
        #: Per position: first arcs of the states (and the end), labels, targets, weights of the arcs.
        self.layers = layers

    @classmethod
    def build(cls, rows: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """From sorted distinct rows; no row gives an automaton without arcs."""
        depth = rows.shape[1]
        if not len(rows):
            empty = np.empty(0, np.int64)
            return cls(0, [(np.zeros(2, np.int64), empty, empty, empty)] * depth)
        begins = [np.zeros(len(rows), bool)]
        begins[0][0] = True
        for d in range(depth):
            begins.append(begins[-1] | np.concatenate([[True], rows[1:, d] != rows[:-1, d]]))
        targets, weights = np.zeros(len(rows), np.int64), counts.astype(np.int64)
        layers = []
        for d in range(depth - 1, -1, -1):
            arcs = np.flatnonzero(begins[d + 1])
            labels = rows[arcs, d].astype(np.int64)
            starts = np.flatnonzero(begins[d][arcs])
            degrees = np.diff(starts, append=len(arcs))
            common = np.minimum.reduceat(weights, starts)
            weights = weights - np.repeat(common, degrees)
            like = _merge(starts, labels, targets, weights)
            kept = np.unique(like)
            own = _spans(starts[kept], degrees[kept])
            firsts = np.concatenate([[0], np.cumsum(degrees[kept])])
            layers.append((firsts, labels[own], targets[own], weights[own]))
            targets, weights = np.searchsorted(kept, like), common
        return cls(int(weights[0]), layers[::-1])

    def arcs(self) -> int:
        """Number of arcs."""
        return sum(len(layer[1]) for layer in self.layers)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences in order, and their counts."""
        state, count = np.zeros(1, np.int64), np.array([self.start], np.int64)
        columns: list[np.ndarray] = []
        for firsts, labels, targets, weights in self.layers:
            degrees = firsts[state + 1] - firsts[state]
            taken = _spans(firsts[state], degrees)
            columns = [np.repeat(c, degrees) for c in columns] + [labels[taken]]
            count = np.repeat(count, degrees) + weights[taken]
            state = targets[taken]
        return np.column_stack(columns), count

    def relabelled(self, numbers: np.ndarray) -> CountAutomaton:
        """The same automaton over other word numbers of the same order."""
        return CountAutomaton(self.start, [(f, numbers[labels], t, w) for f, labels, t, w in self.layers])

    def composed(self, counts: CountAutomaton) -> tuple[np.ndarray, np.ndarray]:
        """The sequences that both have, with their counts in ``counts``: both are walked at once, arc by arc."""
        mine, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
        count = np.array([counts.start], np.int64)
        columns: list[np.ndarray] = []
        for (firsts, labels, targets, _), (firsts2, labels2, targets2, weights2) in zip(self.layers, counts.layers):
            degrees = firsts[mine + 1] - firsts[mine]
            taken = _spans(firsts[mine], degrees)
            asked = labels[taken]
            span = int(max(labels2.max(initial=0), asked.max(initial=0))) + 1
            keys = np.repeat(np.arange(len(firsts2) - 1), np.diff(firsts2)) * span + labels2
            wanted = np.repeat(other, degrees) * span + asked
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            hit = np.flatnonzero(keys[at] == wanted) if len(keys) else np.empty(0, np.int64)
            came = np.repeat(np.arange(len(mine)), degrees)[hit]
            columns = [c[came] for c in columns] + [asked[hit]]
            count = count[came] + weights2[at[hit]]
            mine, other = targets[taken[hit]], targets2[at[hit]]
        return np.column_stack(columns), count

    def packed(self) -> bytes:
        """As bytes."""
        parts = [part for firsts, *rest in self.layers for part in (np.diff(firsts), *rest)]
        head = [len(self.layers), self.start, *map(len, parts)]
        return zstandard.compress(np.concatenate([np.array(head, np.int64), *parts]).astype("<i8").tobytes(), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> CountAutomaton:
        """From :meth:`packed`."""
        flat = np.frombuffer(zstandard.decompress(data), "<i8")
        depth, start = flat[:2].tolist()
        ends = 2 + 4 * depth + np.cumsum(flat[2 : 2 + 4 * depth])
        parts = np.split(flat, ends)
        parts[0] = parts[0][2 + 4 * depth :]
        layers = [(np.concatenate([[0], np.cumsum(parts[i])]), *parts[i + 1 : i + 4]) for i in range(0, 4 * depth, 4)]
        return cls(start, layers)


def union(automata: list[CountAutomaton]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences of all automata over the same word numbers, with the sums of their counts."""
    found = [a.paths() for a in automata]
    return grouped(np.concatenate([rows for rows, _ in found]), np.concatenate([counts for _, counts in found]))


def pack_words(words: list[bytes]) -> bytes:
    """A list of words as bytes."""
    lengths = np.array([len(words), *map(len, words)], "<u4")
    return zstandard.compress(lengths.tobytes() + b"".join(words), 1)


def unpack_words(data: bytes) -> list[bytes]:
    """From :func:`pack_words`."""
    flat = zstandard.decompress(data)
    n = int(np.frombuffer(flat[:4], "<u4")[0])
    ends = (4 * (n + 1) + np.cumsum(np.frombuffer(flat[4 : 4 * (n + 1)], "<u4"), dtype=np.int64)).tolist()
    return [flat[a:b] for a, b in zip([4 * (n + 1), *ends], ends)]
