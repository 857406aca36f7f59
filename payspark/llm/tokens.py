"""Token ids of whole texts with a cache of white-space separated chunks.

The tokenizers served here drop white space before they split and merge, so the ids of a text are those of its chunks
one after the other.  A chunk is encoded once and looked up afterwards.  A chunk of Latin letters with marks behind it,
by far the commonest kind, is split there, as the tokenizer's own pattern does, and its word goes in lower case straight to the
merge model; all other chunks go through the whole tokenizer.  Both short cuts are tried against the tokenizer before
they are used, and one that it does not support is left out.  The caches are emptied when they are full, which costs time and
changes nothing.  Texts with one of the four control characters that Python counts as white space and the tokenizer
does not are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

CACHED_CHUNKS = 500_000
CONTROL = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Latin letters (composed, one letter each in lower case), then ASCII marks other than the apostrophe.
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@[-`{-~]*)")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, int]:
    """Byte-level alphabet: visible Latin-1 characters stand for their own byte, the others for 256 and up, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


class ChunkEncoder:
    """What ``of`` makes of each chunk's ids; ``of`` of joined lists must be the sum of its values."""

    def __init__(self, path: str, of, cached_chunks: int = CACHED_CHUNKS):
        self.tokenizer, self.of, self.limit = load_tokenizer(path), of, cached_chunks
        self.cache: dict[str, object] = {}
        self.words: dict[str, object] = {}
        self.marks: dict[str, object] = {}
        self.letters = byte_letters()
        probe = ["Ab c", "x1\n\t y.", " q  'll", "é\xa0e z!"]
        self.by_chunk = all(self._whole(t) == [i for c in t.split() for i in self._whole(c)] for t in probe)
        probe = ["Hello,", "été", "STRAßE!!", "Ñandú%%%", "x", "über.", "reading$$$"]
        self.by_word = True
        self.by_word = self.by_chunk and all(of(self._whole(c)) == self._split(*WORD.fullmatch(c).groups()) for c in probe)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _split(self, word: str, marks: str):
        word = word.lower()
        if (value := self.words.get(word)) is None:
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            value = self.words[word] = self.of([t.id for t in self.tokenizer.model.tokenize(letters)])
        if not marks:
            return value
        if (end := self.marks.get(marks)) is None:
            end = self.marks[marks] = self.of(self._whole(marks))
        return value + end

    def learn(self, texts: list[str]) -> None:
        """Encode the unknown chunks of several texts."""
        if not self.by_chunk:
            return
        new = {c for t in texts for c in t.split()}
        if len(self.cache) + len(new) > self.limit:
            self.cache.clear()
        if len(self.words) > self.limit:
            self.words.clear()
        if len(self.marks) > self.limit:
            self.marks.clear()
        new.difference_update(self.cache)
        odd = []
        for c in new:
            if self.by_word and (match := WORD.fullmatch(c)):
                self.cache[c] = self._split(*match.groups())
            else:
                odd.append(c)
        encoded = self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)
        self.cache.update((c, self.of(e.ids)) for c, e in zip(odd, encoded))

    def values(self, text: str) -> list:
        """What is kept of the text's chunks, in order; its texts must have been learnt since the last other call."""
        if not self.by_chunk or any(c in text for c in CONTROL):
            return [self.of(self._whole(text))]
        return [*map(self.cache.__getitem__, text.split())]


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@lru_cache(maxsize=4)
def shared_encoder(path: str, of) -> ChunkEncoder:
    """One encoder per Python worker, so that later tasks find the common chunks."""
    return ChunkEncoder(path, of)
