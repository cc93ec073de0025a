"""Words of a batch of texts: distinct ones once, and what is known of those met last."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def numbered(split: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Of lists of words: the distinct words, for each word its number among them, and where each list ends.

    Null lists have no words.
    """
    found = split.flatten().dictionary_encode()
    sizes = split.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return found.dictionary, found.indices, np.cumsum(sizes, dtype=np.int64)


class Recent:
    """What is known of words, in two halves: when the newer one is full, the older one is dropped.

    A word that is met again goes to the newer half, so that only words not met for long are
    forgotten.  At most ``most`` words are known, besides those of one batch.
    """

    def __init__(self, most: int):
        self.half = most // 2
        self.new: dict = {}
        self.old: dict = {}

    def __len__(self) -> int:
        return len(self.new) + len(self.old)

    def find(self, words: list) -> list:
        """What is known of each word; None if it is not known."""
        found = list(map(self.new.get, words))
        if self.old and None in found:
            for k, (word, x) in enumerate(zip(words, found)):
                if x is None and (x := self.old.get(word)) is not None:
                    found[k] = self.new[word] = x
        return found

    def add(self, known: dict) -> None:
        self.new.update(known)
        if len(self.new) > self.half:
            self.old, self.new = self.new, {}
