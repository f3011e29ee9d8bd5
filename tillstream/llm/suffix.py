"""Suffix automata over words."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All runs of words in a set of passages, each with the earliest place where it ends.

    `add` takes a passage's words (as numbers) and the place of its first word; places are
    comparable numbers that grow by one from word to word.
    """

    def __init__(self) -> None:
        self.moves: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.earliest: list[int] = [NOWHERE]

    def add(self, words: Iterable[int], place: int) -> None:
        moves, link, length, earliest = self.moves, self.link, self.length, self.earliest
        last, end = 0, place
        for word in words:
            known = moves[last].get(word)
            if known is None:
                state = self._state({}, length[last] + 1, 0)
                at = last
                while at >= 0:
                    own = moves[at]
                    if word in own:
                        known = own[word]
                        link[state] = known if length[known] == length[at] + 1 else self._split(
                            at, word, known)
                        break
                    own[word] = state
                    at = link[at]
                last = state
            elif length[known] == length[last] + 1:
                # The run is there already, from this or an earlier passage.
                last = known
            else:
                last = self._split(last, word, known)
            if end < earliest[last]:
                earliest[last] = end
            end += 1

    def _state(self, moves: dict[int, int], length: int, link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.earliest.append(NOWHERE)
        return len(self.moves) - 1

    def _split(self, at: int, word: int, known: int) -> int:
        """A state of its own for the shorter runs of `known` that end with a move from `at`."""
        copy = self._state(dict(self.moves[known]), self.length[at] + 1, self.link[known])
        self.link[known] = copy
        while at >= 0 and self.moves[at].get(word) == known:
            self.moves[at][word] = copy
            at = self.link[at]
        return copy

    def settle(self) -> None:
        """Hands each state's earliest place on to the shorter runs inside; call after adding."""
        link, earliest = self.link, self.earliest
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            shorter = link[state]
            if earliest[state] < earliest[shorter]:
                earliest[shorter] = earliest[state]

    def matches(self, words: Sequence[int], most: int) -> list[tuple[int, int]]:
        """Matching statistics, cut at `most`: after each word, the length of the longest run that
        ends there and is known, and the earliest place where that run ends."""
        moves, link, length, earliest = self.moves, self.link, self.length, self.earliest
        state, matched, found = 0, 0, []
        for word in words:
            after = moves[state].get(word)
            while after is None and state:
                state = link[state]
                matched = length[state]
                after = moves[state].get(word)
            if after is None:
                found.append((0, NOWHERE))
                continue
            state, matched = after, matched + 1
            if matched > most:
                matched = most
            while length[link[state]] >= matched:
                state = link[state]
            found.append((matched, earliest[state]))
        return found


NOWHERE = 1 << 200
