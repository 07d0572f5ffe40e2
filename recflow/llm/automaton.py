"""One deterministic automaton for many byte patterns, and its scan over whole batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import numpy as np

from re import _constants as _kind
from re import _parser

_ALL = frozenset(range(256))
# By name, as the constants themselves cannot be sent to executors.
_CLASSES = {
    "CATEGORY_DIGIT": frozenset(b"0123456789"),
    "CATEGORY_SPACE": frozenset(b" \t\n\r\x0b\x0c"),
    "CATEGORY_WORD": frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"),
}
_CLASSES |= {k.replace("_", "_NOT_"): _ALL - v for k, v in _CLASSES.items()}


# Chunks that are walked at a time, so that a very long text needs no more memory than many short ones.
LANES = 1 << 14


class _Graph:
    """A nondeterministic automaton: empty moves, and moves over sets of bytes."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def node(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, items: Iterable, start: int, fold: bool, back: bool) -> int:
        """Append a parsed pattern behind ``start``; its last node. ``back`` builds the mirror image."""
        for op, arg in reversed(list(items)) if back else items:
            if op is _kind.SUBPATTERN:
                start = self.add(arg[3], start, fold, back)
            elif op is _kind.BRANCH:
                end = self.node()
                for way in arg[1]:
                    self.empty[self.add(way, start, fold, back)].append(end)
                start = end
            elif op is _kind.MAX_REPEAT:
                least, most, inner = arg
                for _ in range(least):
                    start = self.add(inner, start, fold, back)
                if most is _kind.MAXREPEAT:
                    loop, end = self.node(), self.node()
                    self.empty[start].append(loop)
                    self.empty[self.add(inner, loop, fold, back)].append(loop)
                    self.empty[loop].append(end)
                    start = end
                else:
                    end = self.node()
                    self.empty[start].append(end)
                    for _ in range(most - least):
                        start = self.add(inner, start, fold, back)
                        self.empty[start].append(end)
                    start = end
            else:
                end = self.node()
                self.moves[start].append((self.bytes_of(op, arg, fold), end))
                start = end
        return start

    @staticmethod
    def bytes_of(op: object, arg: object, fold: bool) -> frozenset[int]:
        if op is _kind.LITERAL:
            found = {arg}
        elif op is _kind.NOT_LITERAL:
            return _ALL - _Graph.bytes_of(_kind.LITERAL, arg, fold)
        elif op is _kind.ANY:
            return _ALL - {10}
        elif op is _kind.IN:
            if arg[0][0] is _kind.NEGATE:
                return _ALL - _Graph.bytes_of(op, arg[1:], fold)
            found = set().union(*(_Graph.bytes_of(o, a, fold) for o, a in arg))
        elif op is _kind.RANGE:
            found = set(range(arg[0], arg[1] + 1))
        elif op is _kind.CATEGORY:
            found = set(_CLASSES[str(arg)])
        else:
            raise ValueError(f"a pattern may not use {op}")
        if fold:
            found |= {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)


class Automaton:
    """The minimal deterministic automaton of some patterns.

    ``classes`` maps a byte to its class, ``moves[state, class]`` to the next state, ``accepts[state]`` to a
    bit for each pattern that ends there. State 0 is the start. Accepting states have the largest numbers.
    """

    def __init__(self, patterns: Sequence[tuple[bytes, bool]], anywhere: bool, back: bool = False) -> None:
        graph = _Graph()
        start = graph.node()
        ends = {}
        for i, (pattern, fold) in enumerate(patterns):
            own = graph.node()
            graph.empty[start].append(own)
            ends[graph.add(_parser.parse(pattern), own, fold, back)] = 1 << i
        if anywhere:
            graph.moves[start].append((_ALL, start))
        moves, accepts = self._subsets(graph, start, ends)
        self._minimise(moves, accepts)

    def _subsets(self, graph: _Graph, start: int, ends: dict[int, int]) -> tuple[np.ndarray, list[int]]:
        sets = sorted({s for ms in graph.moves for s, _ in ms}, key=sorted)
        signature = [tuple(b in s for s in sets) for b in range(256)]
        number: dict[tuple, int] = {}
        self.classes = np.array([number.setdefault(x, len(number)) for x in signature], np.uint8)
        example = [signature.index(x) for x in number]
        over = [[(frozenset(c for c, b in enumerate(example) if b in s), to) for s, to in ms] for ms in graph.moves]
        reached: dict[int, frozenset[int]] = {}

        def closed(node: int) -> frozenset[int]:
            if node not in reached:
                seen, left = {node}, [node]
                while left:
                    for x in graph.empty[left.pop()]:
                        if x not in seen:
                            seen.add(x)
                            left.append(x)
                # only nodes with moves or an end tell states apart
                reached[node] = frozenset(x for x in seen if over[x] or x in ends)
            return reached[node]

        first = closed(start)
        states, rows, left = {first: 0}, [], [first]
        for state in left:
            targets: list[set[int]] = [set() for _ in example]
            for node in state:
                for some, to in over[node]:
                    for c in some:
                        targets[c] |= closed(to)
            row = []
            for target in map(frozenset, targets):
                if target not in states:
                    states[target] = len(states)
                    left.append(target)
                row.append(states[target])
            rows.append(row)
        accepts = [sum({ends[x] for x in state if x in ends}) for state in left]
        return np.array(rows, np.int64), accepts

    def _minimise(self, moves: np.ndarray, accepts: list[int]) -> None:
        """Split the states by what they accept, then by where they lead, until nothing splits."""
        block = np.unique(np.array(accepts), return_inverse=True)[1].reshape(-1)
        while True:
            seen = np.column_stack([block, block[moves]])
            finer = np.unique(seen, axis=0, return_inverse=True)[1].reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        members = np.unique(block, return_index=True)[1]
        order = sorted(range(len(members)), key=lambda b: (accepts[members[b]] != 0, b != block[0]))
        renamed = np.empty(len(members), np.int64)
        renamed[order] = np.arange(len(members))
        self.moves = renamed[block[moves[members[order]]]]
        self.accepts = np.array([accepts[members[b]] for b in order], np.int64)
        if self.accepts[0]:
            raise ValueError("a pattern matches the empty text")
        self.first_accepting = int(np.count_nonzero(self.accepts == 0))
        n = len(order)
        dead = [s for s in range(n) if not self.accepts[s] and (self.moves[s] == s).all()]
        self.dead = dead[0] if dead and dead[0] else -1

    def longest(self, data: bytes, start: int, step: int, stop: int) -> int:
        """The last accepting place of a walk from ``start`` in steps of 1 or -1, or -1."""
        state, best, at = 0, -1, start
        classes, moves, accepts = self.classes, self.moves, self.accepts
        while at != stop:
            state = moves[state, classes[data[at if step > 0 else at - 1]]]
            at += step
            if state == self.dead:
                break
            if accepts[state]:
                best = at
        return best


class Scanner:
    """All ends of matches in a batch of texts, in one pass over its bytes.

    The texts are cut into chunks that advance together, one byte a step. Every chunk starts in state 0;
    where the chunk before ended in another state, it is walked again from there until it meets its own
    earlier states, which takes a few bytes unless a match spans the cut.
    """

    def __init__(self, automaton: Automaton, chunk: int = 512) -> None:
        self.automaton, self.chunk = automaton, chunk
        # one more class, for the padding, leads back to the start
        n, k = automaton.moves.shape
        self.width = k + 1
        moves = np.zeros((n, k + 1), np.int32)
        moves[:, :k] = automaton.moves
        self.moves = (moves * self.width).reshape(-1)

    def ends(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, end, accepted patterns as bits), in order."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        lanes = -(-size // self.chunk)
        owner = np.repeat(np.arange(len(texts)), lanes)
        if not len(owner):
            return owner, owner, owner
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = (np.cumsum(size) - size)[owner] + nth * self.chunk
        length = np.minimum(size[owner] - nth * self.chunk, self.chunk)
        data = self.automaton.classes[np.frombuffer(b"".join(texts), np.uint8)]
        found, carried = [], 0
        for a in range(0, len(owner), LANES):
            some = slice(a, a + LANES)
            t, lane, state, carried = self._walk(data, begin[some], length[some], nth[some], carried)
            bits = self.automaton.accepts[state // self.width]
            found.append((owner[some][lane], nth[some][lane] * self.chunk + t + 1, bits))
        who, end, bits = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((end, who))
        return who[order], end[order], bits[order]

    def _walk(
        self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, nth: np.ndarray, carried: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(step, chunk, state) of all accepting steps of some chunks, and the state after the last chunk."""
        step = np.arange(self.chunk)[:, None]
        seen = data.take(begin[None, :] + step, mode="clip")
        seen[step >= length[None, :]] = self.width - 1
        states = np.empty(seen.shape, np.int32)
        state, at = np.zeros(len(begin), np.int32), np.empty(len(begin), np.int32)
        for t in range(self.chunk):
            np.add(state, seen[t], out=at)
            np.take(self.moves, at, out=states[t])
            state = states[t]
        entered = np.zeros(len(begin), np.int32)
        while True:
            entry = np.where(nth > 0, np.concatenate([[carried], states[-1, :-1]]), 0)
            wrong = np.flatnonzero(entry != entered)
            if not len(wrong):
                break
            entered[wrong] = entry[wrong]
            state = entry[wrong]
            for t in range(self.chunk):
                state = self.moves[state + seen[t, wrong]]
                differs = state != states[t, wrong]
                wrong, state = wrong[differs], state[differs]
                if not len(wrong):
                    break
                states[t, wrong] = state
        t, lane = np.nonzero(states >= self.automaton.first_accepting * self.width)
        return t, lane, states[t, lane], int(states[-1, -1])


def compiled(pattern: bytes, fold: bool) -> re.Pattern[bytes]:
    return re.compile(pattern, re.IGNORECASE if fold else 0)
