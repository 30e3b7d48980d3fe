"""Token ids of the parts of texts, remembered by a 64-bit hash of the part.

Texts repeat their words, and tokenizers cost far more than a lookup. A memory is sorted keys with a slot each, and
for each slot the ids of the part in one pool per tokenizer: some bytes a part instead of Python objects.
It holds a bounded number of parts and starts anew beyond.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd

#: For the new parts' places: ids of all of them in a row and how many each has, for each tokenizer.
Learn = Callable[[np.ndarray], Sequence[tuple[np.ndarray, np.ndarray]]]


class Pool:
    """Ids of all slots in one growing array."""

    def __init__(self) -> None:
        self.ids = np.empty(1 << 12, np.uint32)
        self.used = 0
        self.at = self.size = np.empty(0, np.int64)

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(2 * need - self.used, np.uint32)])
        self.ids[self.used : need] = ids
        self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used = need

    def take(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these slots in a row, and how many each has."""
        size = self.size[slot]
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        return self.ids[np.repeat(self.at[slot] - after + size, size) + np.arange(total)], size


class Memory:
    """Slots of parts."""

    def __init__(self, tokenizers: int, limit: int) -> None:
        self.tokenizers, self.limit = tokenizers, limit
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slot_of = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.pools = [Pool() for _ in range(self.tokenizers)]

    def slots(self, hashes: np.ndarray, learn: Learn) -> np.ndarray:
        """The slot of every part in ``pools``, until the next call; ``learn`` is asked for the ids of parts not seen yet."""
        code, keys = pd.factorize(hashes)
        if len(self.keys) + len(keys) > self.limit and len(self.keys):
            known = np.isin(keys, self.keys, assume_unique=True)
            if len(self.keys) + np.count_nonzero(~known) > self.limit:
                self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            first = np.empty(len(keys), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            found = learn(first[new])
            have = len(self.slot_of)
            for pool, (ids, size) in zip(self.pools, found):
                pool.add(ids, size)
            keys_new = keys[new]
            merged = np.concatenate([self.keys, keys_new])
            order = np.argsort(merged, kind="stable")
            self.keys = merged[order]
            self.slot_of = np.concatenate([self.slot_of, have + np.arange(len(keys_new))])[order]
            at = np.searchsorted(self.keys, keys)
        return self.slot_of[at][code] if len(keys) else np.empty(0, np.int64)
