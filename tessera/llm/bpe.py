"""Token ids and counts of whole texts, by the ``tokenizers`` library.

A text may be cut before a space or line feed that stands alone between two
non-space characters, and between an ASCII letter and a comma or full stop: the
byte-level pre-tokenizer starts a new piece there, and neither merges nor added
tokens reach over it. So the token sequence of a text is the
concatenation of the sequences of such chunks. Chunks repeat a lot (words with a
space before them), so a worker keeps the results of the chunks it has seen, up
to a fixed number of characters, and sends only new chunks to the library, in
batches of a fixed number of characters.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark runs one task per core

CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
CUT_BACK = re.compile(r"(?s).*\S(?=[ \n]\S)")
OTHER_SPACE = re.compile(r"[^\S \n]")
SPACE = "\u0120"             # how the byte-level alphabet writes a space
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
BLOCK_CHARS = 1 << 18       # a long text is handled in blocks of about this many characters
BATCH_CHARS = 1 << 15       # what one call of the library gets, at least one chunk
KEPT_CHARS = 12 << 20       # chunks remembered by a worker, in characters

_CODERS: dict = {}


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """Consecutive parts of ``text``, each cut at a safe boundary; a run without one stays whole."""
    at = 0
    while len(text) - at > size:
        m = CUT_BACK.match(text, at, at + size)
        n = m or CUT.search(text, at + size - 1)
        to = n.end() if n else len(text)
        yield text[at:to]
        at = to
    if at < len(text):
        yield text[at:]


def by_size(chunks: list[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Batches of about ``limit`` characters each."""
    batch, size = [], 0
    for c in chunks:
        if batch and size + len(c) > limit:
            yield batch
            batch, size = [], 0
        batch.append(c)
        size += len(c) + 1
    if batch:
        yield batch


class ChunkCoder:
    """Remembers ``value(encoding)`` of chunks; values of neighbouring chunks add up."""

    def __init__(self, path: str, value: Callable, of_tokens: Callable):
        from tokenizers import Tokenizer

        self.tok, self.value, self.of_tokens = Tokenizer.from_file(path), value, of_tokens
        self.model = self.tok.model
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kept: dict = {}        # chunk (without a leading space) -> value
        self.chars = 0
        self.tail = dict(zip(",.", self.encode([",", "."])))

    def encode(self, texts: list[str]) -> list:
        out = []
        for batch in by_size(texts):
            out += map(self.value, self.tok.encode_batch_fast(batch, add_special_tokens=False))
        return out

    def values(self, block: str) -> list:
        """The values of the block's chunks, in text order."""
        chunks = block.replace("\n", " \n").split(" ")
        head = chunks.pop(0)
        new = set(chunks).difference(self.kept)
        if "" in new or "\n" in new or OTHER_SPACE.search(block):
            return self.encode(CUT.split(block))      # runs of white space: cut only where it is safe, remember nothing
        if new:
            if self.chars > KEPT_CHARS:
                self.kept.clear()
                self.chars = 0
                new = set(chunks)
            self.learn(new)
        out = list(map(self.kept.__getitem__, chunks))
        if head:
            out[:0] = self.encode([head])
        return out

    def learn(self, new: set[str]) -> None:
        kept, tail = self.kept, self.tail
        ended = [c for c in new if c[-1] in tail and c[-2:-1] in LETTERS]
        plain = new.difference(ended)
        plain.update({c[:-1] for c in ended}.difference(kept))
        # a space and ASCII letters are one piece of the pre-tokenizer: they go straight to the library's model
        letters = [c for c in plain if c.isascii() and c.isalpha()]
        tokenize, of_tokens = self.model.tokenize, self.of_tokens
        kept.update((c, of_tokens(tokenize(SPACE + c))) for c in letters)
        rest = list(plain.difference(letters))
        kept.update(zip(rest, self.encode([c if c[0] == "\n" else " " + c for c in rest])))
        for c in ended:
            kept[c] = kept[c[:-1]] + tail[c[-1]]
        self.chars += sum(map(len, new)) + sum(map(len, plain))


def _coder(path: str, kind: str) -> ChunkCoder:
    """One coder per worker process, tokenizer and kind of value."""
    if (path, kind) not in _CODERS:
        if kind == "count":
            _CODERS[path, kind] = ChunkCoder(path, len, len)
        else:
            _CODERS[path, kind] = ChunkCoder(path, lambda e: array("I", e.ids).tobytes(),
                                             lambda tokens: array("I", [t.id for t in tokens]).tobytes())
    return _CODERS[path, kind]


def count_tokens(path: str, text: str | None) -> int:
    coder = _coder(path, "count")
    return sum(sum(coder.values(b)) for b in blocks(text or ""))


def id_blocks(path: str, text: str | None) -> Iterator[bytes]:
    """The ids of a text, block by block, as little-endian unsigned 32-bit integers."""
    coder = _coder(path, "ids")
    for b in blocks(text or ""):
        yield b"".join(coder.values(b))
