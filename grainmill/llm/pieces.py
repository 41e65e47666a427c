"""SentencePiece encoding and decoding as weighted finite-state transducers.

Three machines are compiled from a model file:

* ``Normaliser``: two states, before and after the first character; an arc per character that puts
  out U+2581 for a space and the character itself otherwise, the first arc with one U+2581 in front;
* ``Lexicon``: the pieces as a trie over characters, with a final arc that puts out a piece's id;
* ``ByteFallback``: an arc per character that is no piece, putting out the ids of its UTF-8 bytes.

An input is composed with them lazily, arc by arc, and the path of least cost in the tropical
semiring (costs add along a path, the least of all paths counts) is found by relaxing the arcs in
the order of the text.

A byte-pair model is not a unigram model: the least sum of piece scores is not its segmentation.
Its weights sit on pairs of arcs: piece ``b`` after ``a`` costs ``JOIN`` if merging the characters of
``a + b`` by the model's own rule ends in exactly ``a, b``, and infinity otherwise; a byte fallback
costs ``BYTES`` after anything. A path of finite cost is then the model's segmentation of what it
covers, and there is one at most per place: in the merge order of the whole text the first merge
across a boundary of the path would also have come first within the two pieces beside it. So of the
composed states at a place all but one cost infinity, one is kept, and composition is linear in the
input. Costs of pairs are found when first met and kept.

No piece of the model continues from another character into U+2581, so no path crosses such a place
and the chunks between are encoded once and kept, long ones excepted; a model with such pieces is
encoded whole.

Defined results: null text counts as empty and gives no ids; ids decode to the text exactly if it
has no U+2581 of its own, which comes back as a space as in the library; repeated rows each get their
row; an empty table gives an empty result; other columns are ignored. Models with another
normaliser, or of another type, are refused.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import batches, ship, text_or_empty

SPACE = "▁"
JOIN, BYTES = 1.0, 2.0
#: Kept chunks and pair costs, and the longest chunk that is kept: some 250 MB at most.
CHUNKS, PAIRS, LONGEST = 600_000, 1_000_000, 64
_CHUNK = re.compile("▁+[^▁]*|[^▁]+")
_NONE: dict = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Normaliser:
    """States 0 (nothing read) and 1; every arc costs nothing."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def arc(self, state: int, symbol: str) -> tuple[int, str]:
        """``(next state, output)`` of the only arc."""
        out = SPACE if symbol == " " else symbol
        return 1, out if state else self.prefix + out

    def run(self, text: str) -> str:
        """The output for a whole text, from state 0: what ``arc`` gives symbol by symbol."""
        return self.prefix + text.replace(" ", SPACE) if text else ""


class Lexicon:
    """Pieces as a trie; a node's entry under the empty string is its final arc's piece."""

    def __init__(self, ids: dict[str, int]):
        self.ids, self.root = ids, {}
        for p in ids:
            node = self.root
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p

    def arcs(self, text: str, at: int) -> Iterator[tuple[int, str]]:
        """``(end, piece)`` of every path through the trie from a place of the text."""
        node, end, n = self.root, at, len(text)
        while end < n and (node := node.get(text[end])) is not None:
            end += 1
            if "" in node:
                yield end, node[""]


class ByteFallback:
    """Characters that are no piece, as the ids of their UTF-8 bytes."""

    def __init__(self, ids: list[int]):
        self.ids = ids

    def output(self, symbol: str) -> list[int]:
        return [self.ids[x] for x in symbol.encode("utf-8", "surrogatepass")]


class PieceTransducer:
    """The composed machine of one model file: encoder and decoder."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        if spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not spec.byte_fallback or spec.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models with identity normaliser and byte fallback are compiled")
        if len(model.pieces) > 65536:
            raise ValueError("ids of this model do not fit 16 bits")
        self.score: dict[str, float] = {}
        ids: dict[str, int] = {}
        byte = [0] * 256
        self.spelt: list[bytes] = []
        for i, p in enumerate(model.pieces):
            kind = p.type
            if kind == 6:
                b = int(p.piece[3:5], 16)
                byte[b] = i
                self.spelt.append(bytes([b]))
            elif kind == 1:
                self.score[p.piece], ids[p.piece] = p.score, i
                self.spelt.append(p.piece.replace(SPACE, " ").encode())
            elif kind in (2, 3):
                self.spelt.append(b"" if kind == 3 else " ⁇ ".encode())
            else:
                raise ValueError("user-defined and unused pieces are not compiled")
        self.normaliser = Normaliser(SPACE if norm.add_dummy_prefix else "")
        self.lexicon = Lexicon({p: i for p, i in ids.items() if self.merged(p) == [p]})  # a piece that its own merges do not end in is on no path
        self.fallback = ByteFallback(byte)
        self.chunked = not any(SPACE in p.lstrip(SPACE) for p in ids)
        self.two = [i.to_bytes(2, "little") for i in range(65536)]
        self.pairs: dict[str, dict[str, float]] = {}
        self.n_pairs = 0
        self.chunks: dict[str, bytes] = {}
        self.words = _Words(self)

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def weight(self, a: str, b: str) -> float:
        """Cost of piece ``b`` after arc ``a`` (empty at the start, or a character sent as bytes)."""
        if a not in self.lexicon.ids:
            return JOIN
        row = self.pairs.get(a)
        if row is None:
            row = self.pairs[a] = {}
        cost = row.get(b)
        if cost is None:
            cost = row[b] = JOIN if self.merged(a + b) == [a, b] else math.inf
            self.n_pairs += 1
        return cost

    def shortest(self, text: str) -> tuple[float, list[str]]:
        """Cost and arcs of the shortest path over a normalised text."""
        n, root, ids, pairs = len(text), self.lexicon.root, self.lexicon.ids, self.pairs
        cost, arc = [math.inf] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0
        for at in range(n):
            here, last = cost[at], arc[at]
            if here == math.inf:
                continue
            known = pairs.get(last, _NONE) if last in ids else None
            node, end = root, at
            while end < n and (node := node.get(text[end])) is not None:  # the lexicon's arcs, as ``Lexicon.arcs``
                end += 1
                if (b := node.get("")) is not None:
                    new = here + (JOIN if known is None else known[b] if b in known else self.weight(last, b))
                    if new < cost[end]:
                        cost[end], arc[end] = new, b
            if "" not in root.get(text[at], _NONE) and here + BYTES < cost[at + 1]:
                cost[at + 1], arc[at + 1] = here + BYTES, text[at]
        out, at = [], n
        while at:
            out.append(arc[at])
            at -= len(arc[at])
        return cost[n], out[::-1]

    def _ids(self, text: str) -> bytes:
        two, ids, output = self.two, self.lexicon.ids, self.fallback.output
        return b"".join([two[ids[p]] if p in ids else b"".join([two[i] for i in output(p)]) for p in self.shortest(text)[1]])

    def _chunk(self, chunk: str) -> bytes:
        known = self.chunks.get(chunk)
        if known is None:
            known = self._ids(chunk)
            if len(chunk) <= LONGEST:
                self.chunks[chunk] = known
        return known

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 16-bit integers."""
        if not text:
            return b""
        if self.n_pairs > PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        if len(self.chunks) + len(self.words) > CHUNKS:
            self.chunks.clear()
            self.words.clear()
        if self.chunked and self.normaliser.prefix and SPACE not in text and "  " not in text and text[-1] != " " and text[0] != " ":
            return b"".join(map(self.words.__getitem__, text.split(" ")))
        spaced = self.normaliser.run(text)
        return b"".join(map(self._chunk, _CHUNK.findall(spaced))) if self.chunked else self._ids(spaced)

    def decode(self, ids: bytes) -> str:
        """The inverse machine: an id's characters or byte, U+2581 as a space, without the first one."""
        spelt = self.spelt
        text = b"".join([spelt[i] for i in np.frombuffer(ids, "<u2").tolist()])
        if self.normaliser.prefix and text.startswith(b" "):
            text = text[1:]
        return text.decode("utf-8", "replace")


class _Words(dict):
    """Word to the ids of U+2581 and the word."""

    def __init__(self, owner: PieceTransducer):
        self.owner = owner

    def __missing__(self, word: str) -> bytes:
        ids = self.owner._ids(SPACE + word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


_MODELS: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    """This worker process's transducer of a model file."""
    if path not in _MODELS:
        _MODELS[path] = PieceTransducer(path)
    return _MODELS[path]


_SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


def encode_decode(docs: DataFrame, model: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per document: number and checksum of its ids, digest of what they decode to, exactness."""
    import hashlib

    ship(docs.sparkSession)
    path = model or default_model()
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for b in batches(it):
            rows, ids = [], []
            for text in b.column(1).to_pylist():
                data = t.encode(text)
                wide, back = np.frombuffer(data, "<u2").astype("<u4"), t.decode(data)
                rows.append((len(wide), zlib.crc32(wide.tobytes()), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == text))
                if with_ids:
                    ids.append(wide.astype(np.int32))
            cols = [b.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.bool_())))]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)
