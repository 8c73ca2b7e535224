"""Suffix automaton over the tokens of a vocabulary, as arrays, for many words at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np


class SuffixAutomaton:
    """States are sets of substrings of the tokens that end at the same places.

    Reading a text, the state and the matched length name the longest end of the text that is a substring of
    a token. A token is the longest string of its state, since one of its places is its own start. So the
    tokens that end here are the state's own, if all of it is matched, and those up its suffix links.
    """

    def __init__(self, tokens: dict[bytes, int]):
        ahead: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def extend(last: int, byte: int) -> int:
            known = ahead[last].get(byte)
            if known is not None and length[known] == length[last] + 1:
                return known
            new = None
            if known is None:
                new = len(ahead)
                ahead.append({})
                link.append(0)
                length.append(length[last] + 1)
                while last >= 0 and byte not in ahead[last]:
                    ahead[last][byte] = new
                    last = link[last]
                if last < 0:
                    return new
                known = ahead[last][byte]
                if length[known] == length[last] + 1:
                    link[new] = known
                    return new
            # Part of the state is now found in more places than the rest.
            part = len(ahead)
            ahead.append(dict(ahead[known]))
            link.append(link[known])
            length.append(length[last] + 1)
            link[known] = part
            while last >= 0 and ahead[last].get(byte) == known:
                ahead[last][byte] = part
                last = link[last]
            if new is None:
                return part
            link[new] = part
            return new

        # Sorted, a token starts where it parts from the one before it.
        path, before = [0], b""
        ends = {}
        for token in sorted(tokens):
            same = 0
            while same < min(len(before), len(token)) and before[same] == token[same]:
                same += 1
            del path[same + 1 :]
            for byte in token[same:]:
                path.append(extend(path[-1], byte))
            before = token
        for token in tokens:
            state = 0
            for byte in token:
                state = ahead[state][byte]
            ends[state] = tokens[token]
        count = len(ahead)
        self.length, self.link = np.array(length, np.int32), np.array(link, np.int32)
        self.link[0] = 0
        self.token = np.full(count, -1, np.int32)
        for state, token in ends.items():
            self.token[state] = token
        #: The next state up the links that is a token; 0 for none.
        self.above = np.zeros(count, np.int32)
        for state in np.argsort(self.length, kind="stable")[1:]:
            up = link[state]
            self.above[state] = up if self.token[up] >= 0 else self.above[up]
        keys = np.array([(state << 8) | byte for state, row in enumerate(ahead) for byte in row], np.int64)
        to = np.array([state for row in ahead for state in row.values()], np.int32)
        order = np.argsort(keys)
        self._keys, self._to = keys[order], to[order]

    def step(self, state: np.ndarray, matched: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and matched lengths after one more byte of each text."""
        state, matched = state.copy(), matched.copy()
        todo = np.arange(len(state))
        while len(todo):
            key = (state[todo].astype(np.int64) << 8) | byte[todo]
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            hit = self._keys[at] == key
            found = todo[hit]
            state[found] = self._to[at[hit]]
            matched[found] += 1
            todo = todo[~hit]
            # A byte that is in no token leaves nothing matched.
            lost = state[todo] == 0
            matched[todo[lost]] = 0
            todo = todo[~lost]
            state[todo] = self.link[state[todo]]
            matched[todo] = self.length[state[todo]]
        return state, matched

    def first(self, state: np.ndarray, matched: np.ndarray) -> np.ndarray:
        """The state of the longest token that ends here; 0 for none. The others follow by ``above``."""
        own = (self.token[state] >= 0) & (matched == self.length[state])
        return np.where(own, state, self.above[state])

    @cached_property
    def _ahead(self) -> dict[int, int]:
        return dict(zip(self._keys.tolist(), self._to.tolist(), strict=True))

    @cached_property
    def _links(self) -> tuple[list[int], list[int]]:
        return self.link.tolist(), self.length.tolist()

    @cached_property
    def token_at(self) -> list[tuple[int, int]]:
        """Token and length by state."""
        return list(zip(self.token.tolist(), self.length.tolist(), strict=True))

    @cached_property
    def above_at(self) -> list[int]:
        return self.above.tolist()

    def walk(self, text: bytes) -> Iterator[int]:
        """After each byte, the state of the longest token that ends there."""
        ahead, (link, length), token, above = self._ahead, self._links, self.token_at, self.above_at
        state = matched = 0
        for byte in text:
            while (to := ahead.get(state << 8 | byte)) is None and state:
                state = link[state]
                matched = length[state]
            state, matched = (to, matched + 1) if to is not None else (0, 0)
            found = state if token[state][0] >= 0 and matched == length[state] else above[state]
            if not found:
                raise ValueError("a byte is in no token")
            yield found
