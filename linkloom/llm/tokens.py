"""Token ids of whole texts with the tokenizers library.

The vocabulary's pre-tokenizer never joins across white space, so a text's
ids are the ids of its white-space separated words in order. A worker
remembers the ids of words it has met (as little-endian 32-bit bytes). A new
word that is a run of Latin-1 letters, perhaps with ASCII punctuation behind
it, is two pre-tokens (letters in lower case, punctuation), which the
library's model encodes one by one; these are remembered too. Any other new
word goes through the library's whole pipeline.

Both memories are bounded: a full one becomes the older generation and words
found there move to the new one. That changes no result.
"""

from __future__ import annotations

import os
import re

MEMORY_WORDS = 160_000
MEMORY_PARTS = 250_000
# No apostrophe: the pre-tokenizer gives contractions a token of their own.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
PLAIN_CHARS = "".join(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x100)]))


class Memory(dict):
    """A bounded map in two generations; ``learn`` gives what it does not hold."""

    def __init__(self, size: int, learn):
        self.size, self.learn, self.old = size, learn, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.learn(key)
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.parts = Memory(MEMORY_WORDS, self._word), Memory(MEMORY_PARTS, self._part)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = str.maketrans({c: split(c)[0][0] for c in PLAIN_CHARS})

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token."""
        tokens = self.tokenizer.model.tokenize(part.translate(self.spelling))
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        plain = PLAIN_WORD.fullmatch(text)
        if plain:
            letters, tail = plain.groups()
            ids = self.parts[letters.lower()]
            return ids + self.parts[tail] if tail else ids
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        self.words.turn()
        self.parts.turn()
        return [b"".join(map(self.words.__getitem__, t.split())) for t in texts]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
