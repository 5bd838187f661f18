"""SentencePiece BPE by backtracking over longest matches (operator 5).

A text is cut before each run of blanks that follows other text: no piece spans
that place. Within a segment, Aho-Corasick gives all pieces at every place; the
longest is tried first, and two neighbours stand if merging their characters anew
gives just them. A bitfield keeps places from which no way went on.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import CACHES, KEPT_LETTERS, documents, enter

NAME = "piece_bpe_32k.model"
#: Words and pairs that a worker's memos hold; long ones are not kept.
MEMO = 500_000
_BLANK = "▁"
_SEGMENT = re.compile(f"{_BLANK}*[^{_BLANK}]+|{_BLANK}+")


class PieceCodec:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.text: list[str] = []
        match = ahocorasick.Automaton()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.text.append(piece.replace(_BLANK, " "))
            if sp.is_byte(i):
                self.bytes[i] = int(piece[3:-1], 16)
            elif sp.is_control(i) or sp.is_unknown(i):
                self.text[i] = "" if sp.is_control(i) else " ⁇ "
            else:
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                match.add_word(piece, len(piece))
        match.make_automaton()
        self.match = match
        self.of_byte = {b: i for i, b in self.bytes.items()}
        self.decimal = [str(i) for i in range(len(self.text))]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        if any(_BLANK in p.lstrip(_BLANK) for p in self.ids):
            raise ValueError("a piece spans a blank after other text")

    def merge(self, text: str) -> list[str]:
        """Best score first, then leftmost: the library's rule, in the plain way."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stand(self, a: str, b: str) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            found = self.merge(a + b) == [a, b]
            if len(self.pairs) < MEMO:
                self.pairs[a, b] = found
        return found

    def segment(self, text: str) -> tuple[int, ...]:
        n = len(text)
        lengths: list[list[int]] = [[] for _ in range(n)]
        for end, size in self.match.iter(text):
            lengths[end - size + 1].append(size)
        failed = bytearray(n + 1)
        out: list[str] = []
        tried: list[int] = []  # for each place on the way, how many of its pieces are yet to try
        at = 0
        left = len(lengths[0]) if lengths[0] else 1
        while at < n:
            options = lengths[at] or [1]
            while left:
                left -= 1
                size = options[left]
                piece = text[at : at + size]
                if not failed[at + size] and (not out or self._stand(out[-1], piece)):
                    out.append(piece)
                    tried.append(left)
                    at += size
                    left = (len(lengths[at]) or 1) if at < n else 0
                    break
            else:
                failed[at] = 1
                if not out:
                    return self._ids(self.merge(text))
                at -= len(out.pop())
                left = tried.pop()
        return self._ids(out)

    def _ids(self, parts: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for p in parts:
            i = self.ids.get(p)
            if i is None:
                out += [self.of_byte[b] for b in p.encode()]
            else:
                out.append(i)
        return tuple(out)

    def _known(self, segment: str) -> tuple[int, ...]:
        found = self.memo.get(segment)
        if found is None:
            found = self.segment(segment)
            if len(self.memo) < MEMO and len(segment) <= KEPT_LETTERS:
                self.memo[segment] = found
        return found

    def encode(self, text: str) -> list[int]:
        """All ids of a text, as the library gives them."""
        if not text:
            return []
        return list(chain.from_iterable(map(self._known, _SEGMENT.findall(_BLANK + text.replace(" ", _BLANK)))))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: blanks for their mark but for the first, runs of byte pieces as UTF-8, U+FFFD for each byte that is none."""
        if self.bytes.keys().isdisjoint(ids):
            return "".join(map(self.text.__getitem__, ids))[1 if ids and self.text[ids[0]][:1] == " " else 0 :]
        out, run = [], bytearray()
        for k, i in enumerate(ids):
            if i in self.bytes:
                run.append(self.bytes[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(self.text[i][1:] if k == 0 and self.text[i][:1] == " " else self.text[i])
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out)


def _utf8(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


_loaded: dict[str, PieceCodec] = {}
CACHES.append(_loaded)


def load(path: str | None = None) -> PieceCodec:
    """The worker's codec of a model file; it outlives a task, until the worker goes on to another operator."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(NAME)
    if path not in _loaded:
        _loaded[path] = PieceCodec(path)
    return _loaded[path]


def _run(path: str | None):
    def run(batches):
        enter("pieces")
        codec = load(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = codec.encode(text)
                rows.append((doc, len(ids), sha(",".join(map(codec.decimal.__getitem__, ids))), sha(codec.decode(ids))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def piece_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Null texts are empty: no ids. A very long text is encoded segment by segment;
    one segment (no blank in it) is in memory with its matches. Ties are the
    library's: of merges of one score the leftmost comes first. Other columns are
    ignored; repeated rows give equal rows; an empty table gives none.
    """
    return documents(docs).mapInArrow(_run(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
