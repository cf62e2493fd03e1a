"""Token ids of whole texts, tokenized word by word with a bounded cache.

The vocabularies used here never let a token cross ASCII white space, so the ids of a
text are those of its words in turn; most words occur often, and their ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

#: Words kept per Python worker; when more turn up, the cache starts anew.
CACHED_WORDS = 600_000

_encoders: dict[str, Callable[[str], bytes]] = {}
# A word of Latin letters and the marks that end it: two pieces in the vocabulary's split.
_SIMPLE = re.compile("([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def _byte_marks() -> str:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others follow from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return "".join(chr(b if b in plain else 256 + others.index(b)) for b in range(256))


_BYTE_MARKS = _byte_marks()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class _Words(dict):
    """Ids of each word, as little-endian 32-bit bytes."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.encode = tokenizer.encode_batch_fast
        self.model = tokenizer.model
        self.marks: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        found = self.encode([t.decode() for t in texts], add_special_tokens=False)
        return [_packed(made.ids) for made in found]

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = list(words)
        rest = []
        for word in new:
            text = word.decode()
            simple = _SIMPLE.fullmatch(text)
            if simple is None:
                rest.append(word)
                continue
            letters, marks = simple.groups()
            if marks not in self.marks:
                self.marks[marks] = self._ids([marks.encode()])[0]
            if not letters.isascii():
                letters = letters.lower().encode().decode("latin-1").translate(_BYTE_MARKS)
            # One piece, which no normalising step changes any more.
            ids = _packed([t.id for t in self.model.tokenize(letters)])
            self[word] = ids + self.marks[marks]
        for word, ids in zip(rest, self._ids(rest)):
            self[word] = ids


def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian 32-bit bytes.

    ``path`` names a vocabulary that lower-cases text and drops white space.
    """
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        cache = _Words(tokenizer)

        def encode(text: str) -> bytes:
            if "<|" in text:  # may hold the name of a special token
                return _packed(tokenizer.encode(text, add_special_tokens=False).ids)
            words = text.encode().lower().split()
            try:
                return b"".join(map(cache.__getitem__, words))
            except KeyError:
                cache.learn(set(words))
                return b"".join(map(cache.__getitem__, words))

        _encoders[path] = encode
    return _encoders[path]
