"""A bounded cache of word encodings, kept by a Python worker from task to task."""

from __future__ import annotations

from sys import getsizeof

LONGEST = 64                  # characters; longer words hardly come again and are not kept
WORD_BYTES = 200              # bytes of a word and its ids that a generation has room for, on average


class WordCache(dict):
    """word -> bytes.  Two generations: when ``limit`` words have come in, or ``limit`` times
    ``WORD_BYTES`` bytes of words and ids, the older half is forgotten, so memory stays bounded
    while frequent words stay."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.room, self.size, self.old = limit, limit * WORD_BYTES, 0, {}

    def keep(self, word: str, ids: bytes) -> None:
        if len(word) > LONGEST:
            return
        size = getsizeof(word) + getsizeof(ids)
        if len(self) >= self.limit or self.size + size > self.room:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[word] = ids
        self.size += size

    def put(self, found: dict[str, bytes]) -> None:
        for word, ids in found.items():
            self.keep(word, ids)

    def find(self, word: str) -> bytes | None:
        """The encoding if it is known; a word found in the older half moves to the newer."""
        got = self.get(word)
        if got is None and self.old:
            got = self.old.get(word)
            if got is not None:
                self.keep(word, got)
        return got
