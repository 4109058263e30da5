"""FLAC streams in plain Python and numpy: header facts, and samples that are held against the stream's own digest."""

from __future__ import annotations

import hashlib

import numpy as np

#: Fixed values of the format: block sizes and sample sizes by code.
_BLOCKS = {1: 192, **{i: 576 << i - 2 for i in range(2, 6)}, **{i: 256 << i - 8 for i in range(8, 16)}}
_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


class FlacError(ValueError):
    """The bytes are not a FLAC stream that can be read."""


def facts(raw: bytes) -> tuple[int, int, int, int, bytes, int]:
    """(rate, channels, bits, samples, MD5, where the first frame begins)."""
    at, found = 4, None
    while at + 4 <= len(raw):
        last, kind, size = raw[at] >> 7, raw[at] & 127, int.from_bytes(raw[at + 1 : at + 4], "big")
        if kind == 0 and size >= 34:
            packed = int.from_bytes(raw[at + 14 : at + 22], "big")
            found = (packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1, raw[at + 22 : at + 38])
        at += 4 + size
        if last:
            break
    if raw[:4] != b"fLaC" or found is None or not found[0] or at > len(raw):
        raise FlacError("no stream information")
    return (*found, at)


class _Reader:
    """Bits as text, in which the end of a unary number is found by a search."""

    def __init__(self, raw: bytes):
        self.bits = (np.unpackbits(np.frombuffer(raw, np.uint8)) + 48).tobytes().decode()
        self.at = 0

    def take(self, n: int) -> int:
        if self.at + n > len(self.bits):
            raise FlacError("stream ends within a frame")
        self.at += n
        return int(self.bits[self.at - n : self.at], 2) if n else 0

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value - (1 << n) if n and value >> n - 1 else value

    def unary(self) -> int:
        end = self.bits.find("1", self.at)
        if end < 0:
            raise FlacError("stream ends within a frame")
        n, self.at = end - self.at, end + 1
        return n

    def rice(self, count: int, k: int) -> list[int]:
        bits, at, out = self.bits, self.at, []
        find, put = bits.find, out.append
        for _ in range(count):
            end = find("1", at)
            if end < 0:
                raise FlacError("stream ends within a frame")
            value = end - at << k
            at = end + 1 + k
            if k:
                value |= int(bits[end + 1 : at], 2)
            put(value >> 1 ^ -(value & 1))
        self.at = at
        return out

    def residual(self, block: int, order: int) -> list[int]:
        wide = (4, 5)[self.take(2)]
        parts = 1 << self.take(4)
        out: list[int] = []
        for i in range(parts):
            count = block // parts - (order if i == 0 else 0)
            k = self.take(wide)
            if k == (1 << wide) - 1:
                n = self.take(5)
                out += [self.signed(n) for _ in range(count)]
            else:
                out += self.rice(count, k)
        return out

    def subframe(self, block: int, bits: int) -> np.ndarray:
        self.take(1)
        kind = self.take(6)
        wasted = self.unary() + 1 if self.take(1) else 0
        bits -= wasted
        if kind == 0:
            out = np.full(block, self.signed(bits), np.int64)
        elif kind == 1:
            out = np.array([self.signed(bits) for _ in range(block)], np.int64)
        elif 8 <= kind <= 12:
            order = kind - 8
            start = np.array([self.signed(bits) for _ in range(order)], np.int64)
            out = np.array(self.residual(block, order), np.int64)
            for k in range(order - 1, -1, -1):  # undo one difference after another
                first = np.diff(start, k)[-1]
                out = first + np.cumsum(out)
            out = np.concatenate([start, out])
        elif kind >= 32:
            order = kind - 31
            x = [self.signed(bits) for _ in range(order)]
            precision, shift = self.take(4) + 1, self.signed(5)
            weights = [self.signed(precision) for _ in range(order)][::-1]
            for r in self.residual(block, order):
                x.append(r + (sum(map(int.__mul__, weights, x[-order:])) >> shift))
            out = np.array(x, np.int64)
        else:
            raise FlacError(f"no such kind of subframe: {kind}")
        return out << wasted

    def frame(self, channels: int, bits: int) -> np.ndarray:
        if self.take(14) != 0x3FFE:
            raise FlacError("frame does not begin where it should")
        self.take(2)
        size, rate, how, depth = self.take(4), self.take(4), self.take(4), self.take(3)
        self.take(1)
        lead = self.take(8)
        for _ in range(max(0, 7 - (lead ^ 0xFF).bit_length() if lead >= 0xC0 else 0)):
            self.take(8)
        block = self.take(8) + 1 if size == 6 else self.take(16) + 1 if size == 7 else _BLOCKS.get(size, 0)
        self.take({12: 8, 13: 16, 14: 16}.get(rate, 0))
        self.take(8)  # checksum of the header; the digest of all samples says more
        if not block:
            raise FlacError("no block size")
        bits = _BITS.get(depth, bits)
        count = how + 1 if how < 8 else 2
        if count != channels or how > 10:
            raise FlacError("channels change within the stream")
        x = [self.subframe(block, bits + (how in (8, 10) and c == 1 or how == 9 and c == 0)) for c in range(count)]
        self.at += -self.at % 8
        self.take(16)
        if how == 8:
            x[1] = x[0] - x[1]
        elif how == 9:
            x[0] = x[0] + x[1]
        elif how == 10:
            middle = x[0] << 1 | x[1] & 1
            x = [middle + x[1] >> 1, middle - x[1] >> 1]
        return np.stack(x, axis=1)


def samples(raw: bytes) -> np.ndarray:
    """All samples as integers, frames x channels. A stream whose digest is another is an error."""
    _, channels, bits, total, digest, at = facts(raw)
    reader, parts, have = _Reader(raw[at:]), [], 0
    try:
        while have < total:
            parts.append(reader.frame(channels, bits))
            have += len(parts[-1])
    except (IndexError, ValueError) as exc:
        raise FlacError(str(exc)) from exc
    out = np.concatenate(parts)[:total] if parts else np.empty((0, channels), np.int64)
    if any(digest):
        width = -(-bits // 8)
        plain = out.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
        if hashlib.md5(plain).digest() != digest:
            raise FlacError("samples do not have the stream's digest")
    return out
