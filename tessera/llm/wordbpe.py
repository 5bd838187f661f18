"""Word BPE ids of whole texts: the tokenizers library behind a memo of blank-separated words.

The tokenizer drops white space and no pre-token crosses it, so a text's ids are
those of its words. Each word is encoded once a worker by the library: by its
model alone where ASCII and Latin-1 leave nothing for the normaliser but lower
case, else by the whole tokenizer.
"""

from __future__ import annotations

import re

import numpy as np

from tessera.llm.common import CACHES, KEPT_LETTERS

#: Words that a worker's memo holds; long ones are not kept.
MEMO = 600_000
END = 2
NAME = "word_bpe_49k.json"
_PLAIN = re.compile(r"[!-;=-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's pre-token pattern, for lower-case ASCII and Latin-1 letters.
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: bytes without a printable Latin-1 character get the next code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.memo: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = np.array([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))], "<u4").tobytes()
            if len(self.pieces) < MEMO // 4 and len(piece) <= KEPT_LETTERS:
                self.pieces[piece] = found
        return found

    def word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            return b"".join(map(self._piece, _PRE.findall(word.lower())))
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers, without the end id."""
        words = text.replace("\n", " ").split(" ")
        memo = self.memo
        parts = list(map(memo.get, words))
        if None in parts:
            for i, p in enumerate(parts):
                if p is None:
                    p = memo.get(words[i])
                    if p is None:
                        p = self.word(words[i])
                        if len(memo) < MEMO and len(words[i]) <= KEPT_LETTERS:
                            memo[words[i]] = p
                    parts[i] = p
        return b"".join(parts)


_loaded: dict[str, WordBpe] = {}
CACHES.append(_loaded)


def load(path: str | None = None) -> WordBpe:
    """The worker's encoder of a vocabulary file; it outlives a task, until the worker goes on to another operator."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(NAME)
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
