"""Token-id files: an adaptive context-mixing range coder over independently reset blocks.

A file holds consecutive documents. Its ids, all documents end to end, are cut into blocks of
``BLOCK`` ids; each block has its own coder and model state, its own byte range in the file and a
CRC of its ids, so a damaged block is detected and the others stay readable.

Model. Order 2 and order 1 each keep, per block, a hashed table of the id last confirmed in a
context and how well it has held (0..3); order 0 is the file's id distribution, quantised to 16
bits in the header, to which every block resets. The prediction mixed from them is

    P(id) = a * [id = order-2 guess] + b * [id = order-1 guess] + (1 - a - b) * P0(id)

with weights ``a, b`` that adapt after every id, separately for each pair of confidences. An id is
coded by at most two steps of a 64-bit carry-less range coder: which guess held (12 bits) and, if
none did, the id under P0 (16 bits).

All blocks of a file advance together, one id a step, as numpy vectors over blocks: the coder is
sequential within a block and vectorised across blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, BLOCK, SLOTS = b"GMTOK\x01", 2048, 512
_TOP, _BOT = np.uint64(1 << 48), np.uint64(1 << 40)
_U = np.uint64
_EMPTY = 0xFFFF
_HEAD = struct.Struct("<6sIIQII")


class Corrupt(ValueError):
    """A header or a block does not match its checksum."""


def _order0(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids in use and their frequencies, at least 1 each, which add up to 65536."""
    count = np.bincount(ids, minlength=1).astype(np.float64)
    used = np.flatnonzero(count)
    if not len(used):
        return used.astype("<u2"), used.astype("<u4")
    f = np.maximum(1, np.floor(count[used] / count.sum() * 65536)).astype(np.int64)
    gap = 65536 - int(f.sum())
    if gap > 0:
        f[np.argmax(f)] += gap
    while gap < 0:
        top = np.argsort(-f)[: max(1, min(len(f), -gap))]
        top = top[f[top] > 1]
        f[top] -= 1
        gap += len(top)
    return used.astype("<u2"), f.astype("<u4")


class _Model:
    """State of all blocks: guesses, confidences and mixing weights."""

    def __init__(self, lanes: int, used: np.ndarray, freq: np.ndarray):
        self.base = np.arange(lanes, dtype=np.int64) * SLOTS
        self.lane = np.arange(lanes, dtype=np.int64) * 16
        self.t2 = np.full(lanes * SLOTS, _EMPTY, np.int32)  # id | confidence << 16
        self.t1 = np.full(lanes * SLOTS, _EMPTY, np.int32)
        self.wa = np.full(16 * lanes, 8192, np.int32)
        self.wb = np.full(16 * lanes, 8192, np.int32)
        self.p1 = np.zeros(lanes, np.int64)
        self.h2 = np.zeros(lanes, np.int64)
        f = np.zeros(65537, _U)
        f[used] = freq
        self.order0 = f.copy()  # cumulative << 32 | frequency
        self.order0[1:65536] |= np.cumsum(f[:65535]) << _U(32)
        self.order0[65536] = 65536  # what a held guess leaves to order 0: everything
        self.slot = np.repeat(used.astype(np.uint16), freq)

    def guess(self, n: int) -> None:
        """Guesses and weights for the first ``n`` blocks."""
        p1, base = self.p1[:n], self.base[:n]
        h1 = p1 * 40503
        self.i1 = (h1 >> 5 & (SLOTS - 1)) + base
        self.i2 = (h1 + self.h2[:n] >> 6 & (SLOTS - 1)) + base
        self.h2[:n] = p1 * 50333
        self.e1, self.e2 = self.t1.take(self.i1), self.t2.take(self.i2)
        self.g1, self.g2 = self.e1 & 0xFFFF, self.e2 & 0xFFFF
        self.ctx = self.lane[:n] + ((self.e2 >> 14 & 12) + (self.e1 >> 16))
        self.sa, self.sb = self.wa.take(self.ctx), self.wb.take(self.ctx)
        self.a = (self.sa * 4000 >> 16) + 32
        self.ab = ((4064 - self.a) * self.sb >> 16) + self.a + 1

    def learn(self, n: int, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit2``, ``hit1``: 1 where that guess was coded as held."""
        self.wa[self.ctx] = self.sa + ((hit2 * 65535 - self.sa) >> 5)
        self.wb[self.ctx] = self.sb + ((hit1 * 65535 - self.sb) * (1 - hit2) >> 5)
        for table, at, e, g in ((self.t2, self.i2, self.e2, self.g2), (self.t1, self.i1, self.e1, self.g1)):
            e = e + ((g == ids).astype(np.int32) * 131072 - 65536)
            np.minimum(e, g + 0x30000, out=e)
            table[at] = np.where(e < 0, ids, e)
        self.p1[:n] = ids


def _lanes(n: int) -> tuple[int, int]:
    """Blocks of ``n`` ids and the length of the last one."""
    return -(-n // BLOCK), n - (-(-n // BLOCK) - 1) * BLOCK if n else 0


def encode_ids(ids: np.ndarray, used: np.ndarray, freq: np.ndarray) -> list[bytes]:
    """Each block's bytes."""
    lanes, last = _lanes(len(ids))
    if not lanes:
        return []
    grid = np.zeros(lanes * BLOCK, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)
    m = _Model(lanes, used, freq)
    room = 2 * BLOCK + 8
    out, pos = np.zeros(lanes * room, "<u2"), np.arange(lanes, dtype=np.int64) * room
    low, rng = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
    for t in range(BLOCK if lanes > 1 else last):
        n = lanes if t < last else lanes - 1
        m.guess(n)
        x = grid[t, :n]
        hit2 = (m.g2 == x).astype(np.int32)
        hit1 = (m.g1 == x) * (1 - hit2)
        miss = 1 - hit2 - hit1
        start = m.a * hit1 + m.ab * miss
        width = m.a * hit2 + m.ab * hit1 + 4096 * miss - start
        order0 = m.order0.take((x - 65536) * miss + 65536)
        r = rng[:n] >> _U(12)
        lo = low[:n] + r * start.astype(_U)
        r = (r * width.astype(_U)) >> _U(16)
        lo += r * (order0 >> _U(32))
        r *= order0 & _U(0xFFFFFFFF)
        low[:n], rng[:n] = lo, r
        m.learn(n, x, hit2, hit1)
        todo = np.flatnonzero(((lo ^ (lo + r - _U(1))) < _TOP) | (r < _BOT))
        while len(todo):
            lo, r = low.take(todo), rng.take(todo)
            r = np.where((lo ^ (lo + r - _U(1))) < _TOP, np.minimum(r, _TOP - _U(1)), (_U(0) - lo) & (_BOT - _U(1))) << _U(16)
            p = pos.take(todo)
            out[p] = lo >> _U(48)
            pos[todo] = p + 1
            lo <<= _U(16)
            low[todo], rng[todo] = lo, r
            todo = todo[((lo ^ (lo + r - _U(1))) < _TOP) | (r < _BOT)]
    for k in (48, 32, 16, 0):
        out[pos] = (low >> _U(k)) & _U(0xFFFF)
        pos += 1
    return [out[i * room : p].tobytes() for i, p in enumerate(pos.tolist())]


def decode_ids(blocks: list[bytes], total: int, used: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The ids of all blocks, end to end."""
    lanes, last = _lanes(total)
    if not lanes:
        return np.zeros(0, "<u2")
    m = _Model(lanes, used, freq)
    words = np.frombuffer(b"".join(blocks) + bytes(16), "<u2").astype(_U)
    pos = np.concatenate([[0], np.cumsum([len(b) // 2 for b in blocks])[:-1]]).astype(np.int64)
    code = np.zeros(lanes, _U)
    for _ in range(4):
        code = (code << _U(16)) | words.take(pos, mode="clip")
        pos += 1
    low, rng = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
    grid = np.zeros((BLOCK, lanes), "<u2")
    for t in range(BLOCK if lanes > 1 else last):
        n = lanes if t < last else lanes - 1
        m.guess(n)
        r = rng[:n] >> _U(12)
        lo = low[:n]
        d = code[:n] - lo
        a, ab = m.a.astype(_U), m.ab.astype(_U)
        hit2 = (d < a * r).astype(np.int32)
        hit1 = (d < ab * r) - hit2
        miss = 1 - hit2 - hit1
        u2, u1, u0 = hit2.astype(_U), hit1.astype(_U), miss.astype(_U)
        start = a * u1 + ab * u0
        width = a * u2 + ab * u1 + (u0 << _U(12)) - start
        lo = lo + r * start
        r = (r * width) >> _U(16)
        v = np.minimum((code[:n] - lo) // r, _U(65535)).astype(np.int64)
        x = m.g2 * hit2 + m.g1 * hit1 + m.slot.take(v) * miss
        order0 = m.order0.take((x - 65536) * miss + 65536)
        lo += r * (order0 >> _U(32))
        r *= order0 & _U(0xFFFFFFFF)
        low[:n], rng[:n] = lo, r
        grid[t, :n] = x
        m.learn(n, x, hit2, hit1)
        todo = np.flatnonzero(((lo ^ (lo + r - _U(1))) < _TOP) | (r < _BOT))
        while len(todo):
            lo, r = low.take(todo), rng.take(todo)
            r = np.where((lo ^ (lo + r - _U(1))) < _TOP, np.minimum(r, _TOP - _U(1)), (_U(0) - lo) & (_BOT - _U(1))) << _U(16)
            p = pos.take(todo)
            code[todo] = (code.take(todo) << _U(16)) | words.take(p, mode="clip")
            pos[todo] = p + 1
            lo <<= _U(16)
            low[todo], rng[todo] = lo, r
            todo = todo[((lo ^ (lo + r - _U(1))) < _TOP) | (r < _BOT)]
    return np.ascontiguousarray(grid.T).reshape(-1)[:total]


def write_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One file's bytes: header, document table, order-0 table, block directory, blocks."""
    used, freq = _order0(ids)
    blocks = encode_ids(ids, used, freq)
    crcs = [zlib.crc32(ids[i : i + BLOCK].astype("<u2").tobytes()) for i in range(0, len(ids), BLOCK)]
    null = np.array([d is None for d in doc_ids], np.uint8)
    table = zlib.compress(
        b"".join([
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(), np.array(lengths, "<u4").tobytes(),
            np.array([len(used)], "<u4").tobytes(), used.tobytes(), freq.tobytes(),
            np.array([len(b) for b in blocks], "<u4").tobytes(), np.array(crcs, "<u4").tobytes(),
        ]), 1,
    )
    head = _HEAD.pack(MAGIC, len(doc_ids), len(blocks), len(ids), len(table), 0)[:-4]
    return b"".join([head, zlib.crc32(table, zlib.crc32(head)).to_bytes(4, "little"), table, *blocks])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``(doc_ids, lengths, ids)``; raises ``Corrupt`` naming the first part that is damaged."""
    try:
        magic, n_docs, n_blocks, total, size, crc = _HEAD.unpack_from(data)
    except struct.error as e:
        raise Corrupt("short header") from e
    raw = data[_HEAD.size : _HEAD.size + size]
    if magic != MAGIC or zlib.crc32(raw, zlib.crc32(data[: _HEAD.size - 4])) != crc:
        raise Corrupt("header")
    table, at = zlib.decompress(raw), 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(table, kind, n, at)
        at += out.nbytes
        return out

    docs, null, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    k = int(take("<u4", 1)[0])
    used, freq, sizes, crcs = take("<u2", k), take("<u4", k), take("<u4", n_blocks), take("<u4", n_blocks)
    ends = _HEAD.size + size + np.cumsum(sizes, dtype=np.int64)
    ids = decode_ids([data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())], total, used, freq)
    for i, want in enumerate(crcs.tolist()):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].tobytes()) != want:
            raise Corrupt(f"block {i}")
    return [None if z else d for d, z in zip(docs.tolist(), null.tolist())], lengths, ids
