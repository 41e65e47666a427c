"""Exact, memoised encoding with a public word-level BPE tokenizer of the tokenizers library.

The tokenizer drops white space and never forms a token across it, so a text's ids are the ids of
its white-space separated chunks in order. The texts of a batch are split and their chunks numbered
as arrays, so that each distinct chunk of a batch is looked up once, whatever its count. Each is
encoded by the library once and its ids are kept in a bounded table (long ones, as unspaced scripts
have, are encoded each time). A chunk made of lower-case letters below U+0250 is left as it
is by the tokenizer's normaliser and is one pre-token, so it goes straight to the library's BPE
model; ASCII chunks without an apostrophe split at the letter/digit/punctuation boundaries that the
pre-tokenizer splits at; every other chunk takes the library's whole pipeline.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa

#: Chunks and words per generation of a Python worker's table, and the longest that is kept: with
#: its ids one takes 400 bytes at most, so the table stays near 150 MB whatever the texts hold.
CHUNKS, WORDS, LONGEST = 150_000, 150_000, 64
#: Bytes of text that callers should encode at once, and chunks looked up before the table ages.
BATCH, STEP = 8 << 20, 1 << 15

_PARTS = re.compile(r"[a-z\x80-ɏ]+|[0-9]|[^a-z0-9\x80-ɏ]+")
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c != 39)  # no apostrophe
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
_PLAIN = re.compile(r"[!-&(-@\[-~\xdf-\xf6\xf8-\xff]+")  # lower-case letters, digits, marks; no apostrophe


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return table


class Kept(dict):
    """Results by key in two generations: a full young one becomes the old one, whose entries are
    taken over when they are met again. What is met often so stays, at a bounded size: keys of more
    than ``LONGEST`` are not kept."""

    def __init__(self, make, size: int):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        if len(key) > LONGEST:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


class IdEncoder:
    """Texts to ids, as little-endian unsigned 16-bit ids in bytes."""

    def __init__(self, path: str, room: int = 1):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        if self.lib.get_vocab_size() > 65536:
            raise ValueError("ids of this tokenizer do not fit 16 bits")
        self.table = self.words = Kept(self._chunk, room * (CHUNKS + WORDS))  # a word's ids are those of the chunk it makes
        self.merge = self.lib.model.tokenize
        self.letters = _byte_letters()
        self.two = [i.to_bytes(2, "little") for i in range(65536)]

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _word(self, word: bytes) -> bytes:
        """Ids of one pre-token that the normaliser leaves as it is."""
        spelt = word.decode() if word.isascii() else "".join(map(self.letters.__getitem__, word))
        return b"".join([self.two[t.id] for t in self.merge(spelt)])

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters, lower-case by now
            return self._word(chunk)
        word = chunk.rstrip(_MARKS)
        if word.isalpha():
            return self.words[word] + self.words[chunk[len(word) :]]
        text = chunk.decode("utf-8", "replace")
        if _LETTERS.fullmatch(text):
            return self._word(chunk)
        if _PLAIN.fullmatch(text):
            parts = _PARTS.findall(text)
            return self._word(chunk) if len(parts) == 1 else b"".join([self.words[p.encode()] for p in parts])
        return self.whole(text)

    def _look_up(self, chunks: list[bytes]) -> list[bytes]:
        found = []
        for i in range(0, len(chunks), STEP):
            found += map(self.table.__getitem__, chunks[i : i + STEP])
            self.table.age()
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        special = [i for i, t in enumerate(texts) if b"<|" in t]  # may spell a special token, which is matched before lower-casing
        if special:
            texts = texts.copy()
            aside = [texts[i] for i in special]
            for i in special:
                texts[i] = b""
        out = self._split_and_encode(texts)
        for k, i in enumerate(special):
            out[i] = self.whole(aside[k].decode("utf-8", "replace"))
        return out

    def _split_and_encode(self, texts: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)  # a space behind each text
        space = _SPACE[data]
        at = np.flatnonzero(space).astype(np.int32)
        size = np.diff(at, prepend=np.int32(-1)) - 1
        full = size > 0
        offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int32)[full]], dtype=np.int32)  # of the chunks in the text without spaces
        behind = np.searchsorted(at, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1).astype(np.int32) - 1)  # each text's last space
        ends = np.cumsum(full, dtype=np.int32)[behind].tolist()  # chunks up to each text's end
        data = data[~space]
        del space, at, size, full
        chunks = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        codes, distinct = chunks.indices.to_numpy(zero_copy_only=False), chunks.dictionary
        del offsets, data, chunks
        found = self._look_up(distinct.to_pylist())
        sizes = np.fromiter(map(len, found), np.int32, len(found)) >> 1
        ids, first = np.frombuffer(b"".join(found), "<u2"), np.cumsum(sizes) - sizes
        out, done = [], 0
        while done < len(ends):  # some texts at a time: positions take four times the bytes of ids
            start = ends[done - 1] if done else 0
            upto = max(done + 1, bisect_right(ends, start + STEP, done))
            c = codes[start : ends[upto - 1]]
            n = sizes[c]
            total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            source = np.repeat(first[c] - total[:-1], n)
            source += np.arange(len(source))
            spelt = ids[source].tobytes()
            cuts = [0, *(2 * total[np.array(ends[done:upto]) - start]).tolist()]
            out += [spelt[x:y] for x, y in zip(cuts, cuts[1:])]
            done = upto
        return out


_ENCODERS: dict[tuple[str, int], IdEncoder] = {}


def encoder(path: str, room: int = 1) -> IdEncoder:
    """This worker process's encoder for a tokenizer file; its tables live as long as the worker.

    ``room`` multiplies the size of the tables: more of them is faster, at some 100 MB each.
    """
    if (path, room) not in _ENCODERS:
        _ENCODERS[path, room] = IdEncoder(path, room)
    return _ENCODERS[path, room]
