"""Minimised acceptors of word lists, and their composition with a one-edit transducer.

States are numbered from the leaves up and shared by all languages of an `Acceptors`; equal right
languages are one state. A word's number is its rank in its sorted language: a transition adds the
words that sort before it.

The composition of one acceptor, the transducer and another acceptor has two kinds of states: before
the edit both sides have read the same letters; after it they are two states whose right languages
have to meet. What the states after the edit accept is found once per pair of states.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

Pairs = list[tuple[int, int]]


class Acceptors:
    def __init__(self):
        self.final: list[bool] = []
        self.words: list[int] = []
        # label -> (target, words that sort before)
        self.moves: list[dict[str, tuple[int, int]]] = []
        self._known: dict = {}
        self._met: dict[tuple[int, int], Pairs] = {}

    def _state(self, final: bool, moves: list[tuple[str, int]]) -> int:
        signature = (final, tuple(moves))
        state = self._known.get(signature)
        if state is None:
            state = self._known[signature] = len(self.final)
            before, placed = int(final), {}
            for label, target in moves:
                placed[label] = (target, before)
                before += self.words[target]
            self.final.append(final)
            self.words.append(before)
            self.moves.append(placed)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state of the language of sorted, distinct words."""
        # The path of the last word: per state whether it is final and its finished moves.
        path: list[list] = [[False, []]]
        last = ""
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            self._finish(path, last, shared)
            path.extend([False, []] for _ in range(len(word) - shared))
            path[-1][0] = True
            last = word
        self._finish(path, last, 0)
        return self._state(*path[0])

    def _finish(self, path: list[list], last: str, keep: int) -> None:
        for at in range(len(path) - 1, keep, -1):
            path[at - 1][1].append((last[at - 1], self._state(*path.pop())))

    def _meet(self, one: int, other: int) -> Pairs:
        """Numbers, in both right languages, of the words they have in common."""
        if one == other:
            return [(i, i) for i in range(self.words[one])]
        found = self._met.get((one, other))
        if found is None:
            found = [(0, 0)] if self.final[one] and self.final[other] else []
            mine, theirs = self.moves[one], self.moves[other]
            for label in mine.keys() & theirs.keys():
                (p, i), (q, j) = mine[label], theirs[label]
                found += [(i + a, j + b) for a, b in self._meet(p, q)]
            self._met[one, other] = found
        return found

    def replaced(self, start: int) -> Iterator[tuple[int, int]]:
        """Pairs of words of one language that differ by one replaced letter, each pair once."""
        edits: dict[int, Pairs] = {}
        open_ = [(start, 0)]
        while open_:
            state, base = open_.pop()
            own = edits.get(state)
            if own is None:
                own = edits[state] = []
                moves = list(self.moves[state].values())
                for at, (p, i) in enumerate(moves):
                    for q, j in moves[at + 1:]:
                        own += [(i + a, j + b) for a, b in self._meet(p, q)]
            for a, b in own:
                yield base + a, base + b
            open_ += [(target, base + before) for target, before in self.moves[state].values()]

    def inserted(self, shorter: int, longer: int) -> Iterator[tuple[int, int]]:
        """Pairs of a word and a word of the other language with one letter more, each pair once.

        A letter put beside its like is taken as put after them all.
        """
        edits: dict[tuple[int, int], Pairs] = {}
        open_ = [(shorter, 0, longer, 0)]
        while open_:
            one, base, other, other_base = open_.pop()
            mine, theirs = self.moves[one], self.moves[other]
            own = edits.get((one, other))
            if own is None:
                own = edits[one, other] = []
                for extra, (skipped, before) in theirs.items():
                    if self.final[one] and self.final[skipped]:
                        own.append((0, before))
                    rest = self.moves[skipped]
                    for label in mine.keys() & rest.keys():
                        if label != extra:
                            (p, i), (q, j) = mine[label], rest[label]
                            own += [(i + a, before + j + b) for a, b in self._meet(p, q)]
            for a, b in own:
                yield base + a, other_base + b
            open_ += [(mine[label][0], base + mine[label][1],
                       theirs[label][0], other_base + theirs[label][1])
                      for label in mine.keys() & theirs.keys()]


def allow_depth(letters: int) -> None:
    """Lets `_meet` follow words of so many letters."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * letters + 1000))
