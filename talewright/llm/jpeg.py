"""Progressive JPEG media columns.

Writer: payload bytes become DCT coefficients of a 4:2:0 image, written as spectral-selection and successive-
approximation scans. Reader: scans accumulate into coefficient arrays; restart intervals are independent, so all
intervals of a batch of images are decoded in step with numpy. Blocks are inverse-transformed, chroma is upsampled
and RGB tensors of full size come out. The reader takes any 8-bit progressive Huffman stream of one or three
components; it is fast where restart intervals are short.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A payload byte b is stored as the coefficient b + OFFSET, which is never 0 and always of nine bits.
OFFSET = 256
#: Payload bytes that are coded or decoded at once, and blocks of them for which wide tables are made.
AT_ONCE, BLOCKS = 2 << 20, 1 << 14
#: Samples of a component per MCU row and column: Y 2 x 2, Cb and Cr 1 x 1.
SAMPLING = ((1, 2, 2), (2, 1, 1), (3, 1, 1))


def _zigzag() -> np.ndarray:
    """Place in a row-major 8 x 8 block of each coefficient in scan order."""
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * y + x for y, x in cells])


#: The next marker that is neither a stuffed zero nor a restart.
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]", re.S)
ZIGZAG = _zigzag()
_BASIS_BITS = 14


def _basis() -> np.ndarray:
    """64 x 64 matrix from coefficients in scan order to samples, as integers in float64: products and sums of them are
    exact, so that results do not depend on how a product is blocked."""
    c = np.array([[(math.sqrt(0.125) if u == 0 else 0.5) * math.cos((2 * x + 1) * u * math.pi / 16) for x in range(8)] for u in range(8)])
    full = np.einsum("vy,ux->vuyx", c, c).reshape(64, 64)
    return np.round(full[ZIGZAG] * (1 << _BASIS_BITS))


_BASIS = _basis()


# ---------------------------------------------------------------- writer


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">HH", marker, len(body) + 2) + body


def _table(kind: int, number: int, symbol: int) -> bytes:
    """DHT of one symbol with the one-bit code 0."""
    return _segment(0xFFC4, bytes([kind << 4 | number, 1, *[0] * 15, symbol]))


def _scan_head(component: int, first: int, last: int, high: int, low: int, dc: int, ac: int) -> bytes:
    return _segment(0xFFDA, bytes([1, component, dc << 4 | ac, first, last, high << 4 | low]))


def image_shape(blocks: int) -> tuple[int, int]:
    """MCU rows and columns of the image that holds so many blocks, six to an MCU."""
    mcus = max(1, -(-blocks // 6))
    columns = math.isqrt(mcus - 1) + 1
    return -(-mcus // columns), columns


def _head(rows: int, columns: int, size: int) -> bytes:
    frame = struct.pack(">BHHB", 8, 16 * rows, 16 * columns, 3) + b"".join(bytes([c, h << 4 | v, 0]) for c, h, v in SAMPLING)
    return b"".join((
        b"\xff\xd8", _segment(0xFFFE, b"payload " + str(size).encode()), _segment(0xFFDB, bytes([0, *[1] * 64])), _segment(0xFFC2, frame),
        _table(0, 0, 8), _table(1, 0, 8), _table(1, 1, 0), _segment(0xFFDD, struct.pack(">H", 1)),
    ))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as bytes, the last one filled with ones."""
    spare = -bits.shape[1] % 8
    return np.packbits(np.hstack([bits, np.ones((len(bits), spare), np.uint8)]) if spare else bits, axis=1)


def _scan_rows(values: np.ndarray) -> list[np.ndarray]:
    """Entropy-coded bytes of each block (a row) for the four scans: DC and AC without their last bit, then that bit."""
    n = len(values)
    bit = lambda a: np.unpackbits(a.astype(np.uint8)[:, :, None], axis=2)
    high = (values >> 1).astype(np.uint8)  # 128 to 255: eight bits of size category 8
    coded = np.concatenate([np.zeros((n, 64, 1), np.uint8), bit(high)], axis=2)
    low = (values & 1).astype(np.uint8)
    end_of_block = np.zeros((n, 1), np.uint8)
    return [_packed(coded[:, 0]), _packed(low[:, :1]), _packed(coded[:, 1:].reshape(n, -1)), _packed(np.hstack([end_of_block, low[:, 1:]]))]


def _streams(rows: np.ndarray, number: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows as one byte string with stuffed zeros and restart markers; `number` is a block's place within its scan
    and `last` whether it ends it. Also gives where each row ends."""
    n, width = rows.shape
    full = np.empty((n, width + 2), np.uint8)
    full[:, :width], full[:, width], full[:, width + 1] = rows, 0xFF, 0xD0 + number % 8
    take = np.ones((n, width + 2), np.int64)
    take[:, :width] += rows == 0xFF
    take[last, width:] = 0
    ends = np.cumsum(take.ravel())
    out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    keep = take.ravel() > 0
    out[(ends - take.ravel())[keep]] = full.ravel()[keep]
    return out, ends.reshape(n, width + 2)[:, -1]


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """A progressive JPEG of each payload, whose length is a positive multiple of 64."""
    counts = [len(p) // 64 for p in payloads]
    shapes = [image_shape(c) for c in counts]
    parts = [[(4 * r * c), (r * c), (r * c)] for r, c in shapes]
    raw = b"".join(p + bytes(64 * (6 * r * c) - len(p)) for p, (r, c) in zip(payloads, shapes))
    values = np.frombuffer(raw, np.uint8).reshape(-1, 64)
    sizes = np.array([n for three in parts for n in three])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    number = np.arange(len(values)) - np.repeat(starts[:-1], sizes)
    last = np.zeros(len(values), bool)
    last[starts[1:] - 1] = True
    coded: list[list[np.ndarray]] = [[], [], [], []]
    ended: list[list[np.ndarray]] = [[], [], [], []]
    size = [0] * 4
    for at in range(0, len(values), BLOCKS):
        part = slice(at, at + BLOCKS)
        for k, rows in enumerate(_scan_rows(values[part].astype(np.int32) + OFFSET)):
            data, ends = _streams(rows, number[part], last[part])
            coded[k].append(data)
            ended[k].append(ends + size[k])
            size[k] += len(data)
    streams = [(np.concatenate(data).tobytes(), [0, *np.concatenate(ends)[starts[1:] - 1].tolist()]) for data, ends in zip(coded, ended)]
    heads = ((0, 0, 0, 1, 0, 0), (0, 0, 1, 0, 0, 0), (1, 63, 0, 1, 0, 0), (1, 63, 1, 0, 0, 1))
    out = []
    for i, (payload, (r, c)) in enumerate(zip(payloads, shapes)):
        pieces = [_head(r, c, len(payload))]
        for (data, cuts), h in zip(streams, heads):
            for k in range(3):
                pieces += [_scan_head(k + 1, *h), data[cuts[3 * i + k] : cuts[3 * i + k + 1]]]
        out.append(b"".join([*pieces, b"\xff\xd9"]))
    return out


# ---------------------------------------------------------------- reader


@dataclass
class Scan:
    """One scan of one image: its components, band, bit range, tables and entropy-coded bytes."""

    components: tuple[int, ...]
    band: tuple[int, int]
    bits: tuple[int, int]
    tables: tuple[tuple[bytes, bytes], ...]
    interval: int
    data: tuple[int, int]


@dataclass
class Image:
    """Headers of one file. Coefficients of all components lie behind one another from block `base` of a batch."""

    content: bytes
    height: int = 0
    width: int = 0
    comment: bytes = b""
    parts: list[tuple[int, int, int, int]] = field(default_factory=list)  # identifier, h, v, quantisation table
    scans: list[Scan] = field(default_factory=list)
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    base: int = 0

    @cached_property
    def mcus(self) -> tuple[int, int]:
        h, v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        return -(-self.height // (8 * v)), -(-self.width // (8 * h))

    @cached_property
    def grids(self) -> list[tuple[int, int]]:
        """Block rows and columns of each component, filled up to whole MCUs."""
        rows, columns = self.mcus
        return [(rows * v, columns * h) for _, h, v, _ in self.parts]

    @cached_property
    def starts(self) -> list[int]:
        """First block of each component in the batch, and the end of the last; `base` must be set before."""
        return list(accumulate((rows * columns for rows, columns in self.grids), initial=self.base))

    def own_grid(self, k: int) -> tuple[int, int]:
        """Block rows and columns that a scan of component k alone covers."""
        h, v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        return -(-(-(-self.height * self.parts[k][2] // v)) // 8), -(-(-(-self.width * self.parts[k][1] // h)) // 8)


def parse(content: bytes) -> Image:
    """Headers and scan places of a progressive JPEG."""
    if content[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    image, at, interval = Image(content), 2, 0
    huffman: dict[tuple[int, int], bytes] = {}
    while at < len(content):
        marker = content[at + 1]
        if content[at] != 0xFF:
            raise ValueError(f"no marker at {at}")
        if marker == 0xD9:
            return image
        size = struct.unpack_from(">H", content, at + 2)[0]
        body = content[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            image.comment = body
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                image.quantisers[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                huffman[body[0] >> 4, body[0] & 15] = body[1:n]
                body = body[n:]
        elif marker == 0xC2:
            _, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            image.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("only progressive Huffman streams are read")
        elif marker == 0xDA:
            n = body[0]
            names = [p[0] for p in image.parts]
            which = tuple(names.index(body[1 + 2 * i]) for i in range(n))
            tables = tuple((huffman.get((0, body[2 + 2 * i] >> 4), b""), huffman.get((1, body[2 + 2 * i] & 15), b"")) for i in range(n))
            end = _MARKER.search(content, at).start()
            image.scans.append(Scan(which, (body[1 + 2 * n], body[2 + 2 * n]), (body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15), tables, interval, (at, end)))
            at = end
    raise ValueError("no end of image")


_LOOKUPS: dict[bytes, np.ndarray] = {}


def _lookup(spec: bytes) -> np.ndarray:
    """For each sixteen bits: length of the code that they begin with, times 256, plus its symbol."""
    if spec not in _LOOKUPS:
        out, code, at = np.zeros(1 << 16, np.int64), 0, 16
        for length in range(1, 17):
            for _ in range(spec[length - 1]):
                out[code << 16 - length : code + 1 << 16 - length] = length << 8 | spec[at]
                code, at = code + 1, at + 1
            code <<= 1
        _LOOKUPS[spec] = out
    return _LOOKUPS[spec]


class _Lanes:
    """Restart intervals of one scan of many images, read in step: `pos` is the next bit of each."""

    def __init__(self, images: list[Image], scans: list[Scan]):
        datas = [im.content[s.data[0] : s.data[1]] for im, s in zip(images, scans)]
        raw = np.frombuffer(b"".join(datas) + b"\x00", np.uint8)
        ends = np.cumsum([len(d) for d in datas])
        flag = np.flatnonzero(raw[:-1] == 0xFF)
        after = raw[flag + 1]
        keep = np.ones(len(raw), bool)
        keep[flag[after == 0] + 1] = False
        marks = flag[(after >= 0xD0) & (after <= 0xD7)]
        keep[marks] = keep[marks + 1] = False
        keep[-1] = False
        # lanes begin where an image's scan does and behind each restart marker
        begins = np.sort(np.concatenate([[0], ends[:-1], marks + 2]).astype(np.int64))
        new = np.concatenate([[0], np.cumsum(keep)])
        self.data = np.concatenate([raw[keep], np.full(16, 0xFF, np.uint8)])
        wide = self.data.astype(np.int64)
        self.words = wide[:-7] << 24 | wide[1:-6] << 16 | wide[2:-5] << 8 | wide[3:-4]
        self.pos = new[begins] * 8
        owner = np.searchsorted(ends, begins, side="right")
        units, parts, first, until = [], [], [], []
        at = 0
        for i, (im, s) in enumerate(zip(images, scans)):
            starts = im.starts
            if len(s.components) == 1:
                k = s.components[0]
                (rows, columns), (_, stride) = im.own_grid(k), im.grids[k]
                own = np.arange(starts[k], starts[k + 1]) if columns == stride else starts[k] + (np.arange(rows)[:, None] * stride + np.arange(columns)).ravel()
                own = own[: rows * columns]
                which, group = np.full(len(own), 0), 1
            else:
                (rows, columns), cells, which = im.mcus, [], []
                for j, k in enumerate(s.components):
                    _, h, v, _ = im.parts[k]
                    y = np.arange(rows)[:, None, None, None] * v + np.arange(v)[None, None, :, None]
                    x = np.arange(columns)[None, :, None, None] * h + np.arange(h)[None, None, None, :]
                    cells.append((starts[k] + y * (columns * h) + x).reshape(rows * columns, h * v))
                    which += [j] * (h * v)
                own, group = np.hstack(cells).ravel(), len(which)
                which = np.tile(which, rows * columns)
            step = (s.interval or len(own)) * group
            f = np.arange(0, len(own), step)
            first.append(at + f)
            until.append(at + np.minimum(f + step, len(own)))
            units.append(own)
            parts.append(which)
            at += len(own)
        self.units, self.part = np.concatenate(units), np.concatenate(parts)
        self.first, self.until = np.concatenate(first), np.concatenate(until)
        if len(self.first) != len(begins) or not np.array_equal(np.bincount(owner, minlength=len(images)), [len(f) for f in first]):
            raise ValueError("restart markers do not fit the image")

    def peek(self, lane: np.ndarray) -> np.ndarray:
        p = self.pos[lane]
        return self.words[p >> 3] >> (16 - (p & 7)) & 0xFFFF

    def symbol(self, lane: np.ndarray, look: np.ndarray) -> np.ndarray:
        found = look[self.peek(lane)]
        if not found.all():
            raise ValueError("no such code")
        self.pos[lane] += found >> 8
        return found & 255

    def take(self, lane: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The next n (0 to 16) bits of each lane."""
        value = self.peek(lane) >> (16 - n)
        self.pos[lane] += n
        return value


def _extend(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where((size > 0) & (value < (1 << size >> 1)), value - (1 << size) + 1, value)


def _dc_first(lanes: _Lanes, coef: np.ndarray, scan: Scan, lane: np.ndarray) -> None:
    at, low = lanes.first.copy(), scan.bits[1]
    before = np.zeros((len(at), len(scan.components)), np.int64)
    looks = np.stack([_lookup(t[0]) for t in scan.tables])
    while len(lane):
        part = lanes.part[at[lane]]
        found = looks[part, lanes.peek(lane)]
        lanes.pos[lane] += found >> 8
        size = found & 255
        before[lane, part] += _extend(lanes.take(lane, size), size)
        coef[lanes.units[at[lane]], 0] = before[lane, part] << low
        at[lane] += 1
        lane = lane[at[lane] < lanes.until[lane]]


def _dc_refine(lanes: _Lanes, coef: np.ndarray, scan: Scan, lane: np.ndarray) -> None:
    at = lanes.first.copy()
    while len(lane):
        coef[lanes.units[at[lane]], 0] |= (lanes.take(lane, np.int64(1)) << scan.bits[1]).astype(coef.dtype)
        at[lane] += 1
        lane = lane[at[lane] < lanes.until[lane]]


def _ac_first(lanes: _Lanes, coef: np.ndarray, scan: Scan, lane: np.ndarray) -> None:
    (first, last), low, look = scan.band, scan.bits[1], _lookup(scan.tables[0][1])
    at = lanes.first.copy()
    k = np.full(len(at), first, np.int64)
    flat = coef.reshape(-1)
    while len(lane):
        symbol = lanes.symbol(lane, look)
        run, size = symbol >> 4, symbol & 15
        value = size > 0
        if value.all():
            here = k[lane] + run
            flat[lanes.units[at[lane]] * 64 + here] = _extend(lanes.take(lane, size), size) << low
            k[lane] = here + 1
        else:
            v = lane[value]
            here = k[v] + run[value]
            flat[lanes.units[at[v]] * 64 + here] = _extend(lanes.take(v, size[value]), size[value]) << low
            k[v] = here + 1
            skip = ~value & (run == 15)
            k[lane[skip]] += 16
            end = ~value & (run < 15)
            e = lane[end]
            at[e] += (1 << run[end]) + lanes.take(e, run[end]) - 1
            k[e] = last + 1
        done = k[lane] > last
        if done.any():
            at[lane[done]] += 1
            k[lane[done]] = first
            lane = lane[at[lane] < lanes.until[lane]]


def _ac_refine(lanes: _Lanes, coef: np.ndarray, scan: Scan, lane: np.ndarray) -> None:
    (first, last), low, look = scan.band, scan.bits[1], _lookup(scan.tables[0][1])
    at = lanes.first.copy()
    k, left = np.full(len(at), first, np.int64), np.zeros(len(at), np.int64)
    places = np.arange(first, last + 1)
    while len(lane):
        run, sign = np.full(len(lane), 64), np.zeros(len(lane), np.int64)
        ask = np.flatnonzero(left[lane] == 0)
        if len(ask):
            asking = lane[ask]
            symbol = lanes.symbol(asking, look)
            r, s = symbol >> 4, symbol & 15
            run[ask] = r
            new = s > 0
            sign[ask[new]] = 2 * lanes.take(asking[new], np.int64(1)) - 1
            end = ~new & (r < 15)
            left[asking[end]] = (1 << r[end]) + lanes.take(asking[end], r[end])
            run[ask[end]] = 64
        unit = lanes.units[at[lane]]
        block = coef[unit, first : last + 1]
        begun = block != 0
        open_ = places[None, :] >= k[lane][:, None]
        if (run == 64).all():
            stop = np.full(len(lane), last + 1)
        else:  # the zero that the run leads to
            zeros = np.cumsum(~begun & open_, axis=1)
            past = zeros > run[:, None]
            stop = np.where(past.any(axis=1), first + past.argmax(axis=1), last + 1)
        fix = begun & open_ & (places[None, :] < stop[:, None])
        order = np.cumsum(fix, axis=1)
        rows, columns = np.nonzero(fix)
        p = lanes.pos[lane[rows]] + order[rows, columns] - 1
        bit = lanes.data[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1
        block[rows, columns] += (np.sign(block[rows, columns]) * (bit.astype(block.dtype) << low)).astype(block.dtype)
        lanes.pos[lane] += order[:, -1]
        put = np.flatnonzero((sign != 0) & (stop <= last))
        block[put, stop[put] - first] = sign[put] << low
        coef[unit, first : last + 1] = block
        k[lane] = stop + 1
        ended = left[lane] > 0
        left[lane[ended]] -= 1
        k[lane[ended]] = last + 1
        done = k[lane] > last
        if done.any():
            at[lane[done]] += 1
            k[lane[done]] = first
            lane = lane[at[lane] < lanes.until[lane]]


def read_coefficients(contents: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """Images and the coefficients of all their blocks, in scan order. Scans that agree in all but their data are decoded
    together."""
    images, base = [], 0
    for c in contents:
        images.append(im := parse(c))
        im.base = base
        base = im.starts[-1]
    coef = np.zeros((base, 64), np.int16)
    for turn in range(max((len(im.scans) for im in images), default=0)):
        alike: dict[tuple, list[Image]] = {}
        for im in images:
            if turn < len(im.scans):
                s = im.scans[turn]
                alike.setdefault((s.components, s.band, s.bits, s.tables), []).append(im)
        for group in alike.values():
            scan = group[0].scans[turn]
            lanes = _Lanes(group, [im.scans[turn] for im in group])
            step = (_dc_refine if scan.bits[0] else _dc_first) if scan.band[0] == 0 else (_ac_refine if scan.bits[0] else _ac_first)
            for begin in range(0, len(lanes.first), BLOCKS):
                step(lanes, coef, scan, np.arange(begin, min(begin + BLOCKS, len(lanes.first))))
    return images, coef


def samples(coef: np.ndarray, quantiser: np.ndarray) -> np.ndarray:
    """8-bit samples of blocks, n x 8 x 8."""
    out = np.empty((len(coef), 64), np.uint8)
    for at in range(0, len(coef), BLOCKS):
        product = (coef[at : at + BLOCKS] * quantiser) @ _BASIS
        level = np.floor((product + (1 << _BASIS_BITS - 1)) / (1 << _BASIS_BITS)) + 128
        out[at : at + BLOCKS] = np.clip(level, 0, 255)
    return out.reshape(-1, 8, 8)


def tensor(image: Image, planes: list[np.ndarray]) -> np.ndarray:
    """height x width x 3 tensor of an image from the samples of its components' blocks."""
    hmax, vmax = max(p[1] for p in image.parts), max(p[2] for p in image.parts)
    full = []
    for k, blocks in enumerate(planes):
        rows, columns = image.grids[k]
        plane = blocks.reshape(rows, columns, 8, 8).swapaxes(1, 2).reshape(8 * rows, 8 * columns)
        _, h, v, _ = image.parts[k]
        if (h, v) != (hmax, vmax):
            plane = plane.repeat(vmax // v, axis=0).repeat(hmax // h, axis=1)
        full.append(plane[: image.height, : image.width].astype(np.int32))
    if len(full) == 1:
        return np.repeat(full[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, b, r = full[0], full[1] - 128, full[2] - 128
    # weights of the colour transform in 1/65536
    rgb = np.stack([y + (91881 * r + 32768 >> 16), y - (22554 * b + 46802 * r - 32768 >> 16), y + (116130 * b + 32768 >> 16)], axis=2)
    return np.clip(rgb, 0, 255).astype(np.uint8)


def decode_images(contents: list[bytes]) -> Iterator[tuple[Image, np.ndarray, np.ndarray]]:
    """(image, coefficients, RGB tensor) of each file."""
    images, coef = read_coefficients(contents)
    ready = samples(coef, images[0].quantisers[0]) if images and all(len(im.quantisers) == 1 and 0 in im.quantisers and np.array_equal(im.quantisers[0], images[0].quantisers[0]) for im in images) else None
    for im in images:
        starts = im.starts
        planes = [ready[a:b] if ready is not None else samples(coef[a:b], im.quantisers[im.parts[k][3]]) for k, (a, b) in enumerate(zip(starts, starts[1:]))]
        yield im, coef[starts[0] : starts[-1]], tensor(im, planes)


def stored_payload(image: Image, coef: np.ndarray) -> bytes:
    """The payload that encode_payloads() put in."""
    size = int(image.comment.removeprefix(b"payload "))
    return (coef.reshape(-1)[:size].astype(np.int32) - OFFSET).astype(np.uint8).tobytes()


# ---------------------------------------------------------------- DataFrames


def padded(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % 64 if raw else 64)


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_bytes of the text, media (a progressive JPEG that holds the padded text).

    Null texts count as empty, whose payload is 64 zero bytes. Repeated rows and null or repeated ids give a row each;
    other columns, whatever their names, are not read. Equal texts give equal media. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            texts = batch.column(1)
            while at < len(texts):
                payloads, sizes, begin, size = [], [], at, 0
                while at < len(texts) and size < AT_ONCE:
                    text = texts[at].as_py()
                    payloads.append(padded(text))
                    sizes.append(len((text or "").encode("utf-8", "surrogatepass")))
                    size += len(payloads[-1])
                    at += 1
                yield pa.RecordBatch.from_arrays([batch.column(0)[begin:at], pa.array(sizes, pa.int64()), pa.array(encode_payloads(payloads), pa.binary())], names=["id", "n_bytes", "media"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def decode_media(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", with_tensor: bool = True) -> DataFrame:
    """One row per row of `media`: id, media_bytes, media_sha256, payload_bytes, payload_sha256, tail_crc32, height, width, feature
    and, if asked for, tensor (height * width * 3 bytes, row by row, RGB).

    A null file gives nulls. feature: size, sums of red, green and blue, and the tensor's CRC-32.
    """
    kind = media.schema[id_col].dataType.simpleString()
    types = [("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("feature", pa.string()), *([("tensor", pa.binary())] * with_tensor)]

    def row(content: bytes, image: Image, coef: np.ndarray, rgb: np.ndarray) -> tuple:
        payload = stored_payload(image, coef) if image.comment.startswith(b"payload ") else b""
        raw = rgb.tobytes()
        sums = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64)
        feature = f"{image.height}x{image.width}:{sums[0]}:{sums[1]}:{sums[2]}:{zlib.crc32(raw):08x}"
        return (len(content), hashlib.sha256(content).hexdigest(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), image.height, image.width, feature, *([raw] * with_tensor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (None,) * len(types)
        for batch in batches:
            at, contents = 0, batch.column(1)
            while at < len(contents):  # tensors are as large as what they are made of, so few rows go on at a time
                begin, size, group = at, 0, []
                while at < len(contents) and size < AT_ONCE:
                    group.append(contents[at].as_py())
                    size += len(group[-1] or b"")
                    at += 1
                found = iter(decode_images([c for c in group if c is not None]))
                rows = [none if c is None else row(c, *next(found)) for c in group]
                yield pa.RecordBatch.from_arrays([batch.column(0)[begin:at], *(pa.array(c, t) for c, (_, t) in zip(zip(*rows), types))], names=["id", *(n for n, _ in types)])

    spark_types = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    schema = f"id {kind}, " + ", ".join(f"{n} {spark_types[t]}" for n, t in types)
    return media.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, from encode_media() and decode_media(), whose cases hold; `tensor` is the picture's
    RGB tensor of full size, as stored media columns carry it."""
    return _read_back(spark, sf_dir).select("key.doc_id", "key.n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "height", "width", "tensor")


def _read_back(spark: SparkSession, sf_dir: str, with_tensor: bool = True) -> DataFrame:
    stored = encode_media(table(spark, sf_dir, "documents"))
    return decode_media(stored.select(F.struct("doc_id", "n_bytes").alias("key"), "media"), id_col="key", with_tensor=with_tensor)


def media_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op6_media(), what SQL can tell: sizes and digest of the payload that is read back; tensors stay in the worker."""
    return _read_back(spark, sf_dir, with_tensor=False).select("key.doc_id", "key.n_bytes", "payload_bytes", "payload_sha256")


MEDIA_PAYLOAD_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
e AS (SELECT doc_id, raw, octet_length(raw)::BIGINT AS n FROM d)
SELECT doc_id, n AS n_bytes, greatest(64, (n + 63) // 64 * 64) AS payload_bytes, sha256(raw || unhex(repeat('00', (greatest(64, (n + 63) // 64 * 64) - n)::INT))) AS payload_sha256 FROM e
"""
