"""Levenshtein automata run over a trie of terms, as one deterministic machine built on demand.

A state of the machine is the set of (trie node, edits so far) that the characters read can have
led to: the product of every term's Levenshtein automaton, shared along common prefixes. Moves are
worked out when first needed and kept, so a word costs one dictionary look-up per character.

Terms match within one edit (insert, delete or replace a character) if they are long enough; stems
(terms that stand for all words beginning with them) match exactly and accept whatever follows.
"""

from __future__ import annotations

from collections.abc import Iterable

Match = tuple[int, int]  # term number, edits
LEAST_FUZZY = 5  # shorter terms must match exactly: nearly any short word is one edit away
MOST_KEPT = 200_000


class TermMachine:
    def __init__(self, terms: Iterable[str], stems: Iterable[str] = (), edits: int = 1):
        self.names: list[str] = []
        self.edits = edits
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}
        self.open_ends: dict[int, int] = {}
        for word, kept in [*((t, self.ends) for t in terms), *((s, self.open_ends) for s in stems)]:
            kept[self._node(word)] = len(self.names)
            self.names.append(word)
        # Nodes that lie on a term long enough to be matched with edits.
        self.fuzzy = {0: edits}
        for node, term in self.ends.items():
            if len(self.names[term]) >= LEAST_FUZZY:
                at = 0
                for c in self.names[term]:
                    at = self.children[at][c]
                    self.fuzzy[at] = edits
        self._forget()

    def _node(self, word: str) -> int:
        at = 0
        for c in word:
            if c not in self.children[at]:
                self.children[at][c] = len(self.children)
                self.children.append({})
            at = self.children[at][c]
        return at

    def _forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[Match | None] = []
        self.found: dict[int, Match] = {}
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With characters of the term left out, and without pairs that others make idle."""
        todo = list(pairs)
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                pair = (child, edits + 1)
                if edits < self.fuzzy.get(child, 0) and pair not in pairs:
                    pairs.add(pair)
                    todo.append(pair)
        least: dict[int, int] = {}
        for node, edits in pairs:
            least[node] = min(edits, least.get(node, edits))
        return frozenset(least.items())

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.numbers:
            self.numbers[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.moves.append({})
            ended = [(e, self.ends[n]) for n, e in pairs if n in self.ends
                     and (e == 0 or len(self.names[self.ends[n]]) >= LEAST_FUZZY)]
            best = min(ended, default=None)
            self.accepts.append(best and (best[1], best[0]))
            opened = [self.open_ends[n] for n, e in pairs if n in self.open_ends and e == 0]
            if opened:
                self.found[self.numbers[pairs]] = (min(opened), 0)
        return self.numbers[pairs]

    def _move(self, state: int, c: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            child = self.children[node].get(c)
            if child is not None:
                after.add((child, edits))
            if edits < self.fuzzy.get(node, 0):
                after.add((node, edits + 1))
                after.update((other, edits + 1) for key, other in self.children[node].items()
                             if key != c and other in self.fuzzy)
        return self._state(self._closed(after)) if after else -1

    def match(self, word: str) -> Match | None:
        """The term nearest to the word, or None."""
        if len(self.sets) > MOST_KEPT:
            self._forget()
        state = self.start
        for c in word:
            after = self.moves[state].get(c)
            if after is None:
                after = self.moves[state][c] = self._move(state, c)
            if after < 0:
                return None
            if after in self.found:
                return self.found[after]
            state = after
        return self.accepts[state]
