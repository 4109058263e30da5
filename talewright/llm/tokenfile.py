"""Token-id files in an adaptive context-mixing range coder.

A section renumbers its ids by how often they occur and cuts them into blocks of BLOCK ids that are coded on their own:
models start anew and each block has a checksum. Tables keyed by the last two ids (order 2) and the last one (order 1)
predict the next id. How often each has been right at its present confidence is mixed in the logistic domain, with
weights that adapt, and the result drives the coder: order-2 hit, order-1 hit or escape. An escaped id is coded by its
class of frequency, whose shares adapt (order 0), and its place in that class. All blocks of a section are coded in
step, one id of each at a time, with numpy; shares and weights are renewed at fixed steps.
"""

from __future__ import annotations

import json
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import _SAFE_SPACE, byte_letters, vocabulary_path
from .common import kept_by_worker, shuffle_partitions, staging_path, table

#: Id that ends a document.
END_ID = 2
#: Ids of a block, and of a section at least.
BLOCK, SECTION = 4096, 8 << 20
#: Ids of at most two bytes are coded.
MAX_ID = 0xFFFF
MAGIC = b"TWTK2"
_SPACE = re.compile(r"\s")
#: Marks that may stand behind the letters of a word, and where the letters end that all versions of Unicode have as such.
_MARKS, _LETTERS_END = string.punctuation, "\u0250"
_LINE = re.compile(f"[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+[{re.escape(_MARKS)}]*")
_MARK_LETTER = re.compile(f"[{re.escape(_MARKS)}][^\\W\\d_]")
#: Words of a generation whose ids a worker remembers; a full one becomes the old one, from which words in use come back.
MEMO = 800_000
#: A space between two characters that are not white space is where a text may be cut; this finds two of the latter in a row
#: (a superset of them), in the syntax of Arrow's regular expressions.
_WIDE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]{2}"

#: Entries of the order-2 table of a block, and most entries of its order-1 table.
_S2, _S1 = 2048, 2048
_STRETCH = np.clip(np.round(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int64)
_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2048, 2048) / 256))), 1, 4095).astype(np.int64)
_ONE, _FULL = np.uint32(1 << 16), np.uint32(3 << 16)  # of the confidence that stands above an entry's id
#: Places of a cell: 24 for each step of the order-2 confidence, 6 of the order-1 confidence, 3 for agreement.
_STEPS, _AGREE = np.array([[24], [6]], np.uint8), np.uint8(3)
#: Factors and shift of the hash of two ids.
_MIX = np.uint16(40503), np.uint16(30011), np.uint16(17 - _S2.bit_length())
#: Bits of the shares of frequency classes.
_SHARE = 10
#: An interval is kept between _LOW and _TOP; its top bits leave it as words.
_WORD, _TOP = 20, 1 << 60
_LOW = _TOP >> _WORD


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each place in the order of frequency, first place and bits of each class: single places below 4, then four
    classes for each power of two."""
    place = np.arange(MAX_ID + 1)
    high = np.maximum(np.log2(np.maximum(place, 1)).astype(np.int64), 2)
    of = np.where(place < 4, place, 4 * high - 4 + (place >> high - 2 & 3))
    first = np.flatnonzero(np.diff(of, prepend=-1))
    return of.astype(np.uint8), first.astype(np.uint16), np.round(np.log2(np.diff(np.append(first, MAX_ID + 1)))).astype(np.int64)


_CLASS, _FIRST, _BITS = _classes()


#: Steps of a run at most, whose counts are taken together.
_RUN = 128


def _due(step: int) -> bool:
    """Whether shares and weights are renewed before this step."""
    return step >= 16 and (step % 512 == 0 or step & (step - 1) == 0)


class _Model:
    """State of all blocks (lanes); the same calls in the same order make encoder and decoder agree. Integers only."""

    def __init__(self, lanes: int, alphabet: int, prior: np.ndarray):
        self.lanes, self.classes = lanes, len(prior)
        lane = np.arange(lanes)
        self.size1 = min(_S1, 1 << max(int(alphabet - 1).bit_length(), 1))
        self.base0 = lane * self.classes
        # both tables in one, order 2 first
        self.base = np.stack([lane * _S2, lanes * _S2 + lane * self.size1])
        self.table = np.zeros(lanes * (_S2 + self.size1), np.uint32)
        # (order-2 confidence, order-1 confidence, whether both say the same), three outcomes each
        self.cell = lane * 96
        self.seen = np.zeros(lanes * 96, np.int64)
        self.weights = np.tile(np.array([[45000, 12000], [45000, 25000]]), (lanes, 1, 1))
        self.shares = np.tile(prior.astype(np.int64), (lanes, 1))
        self.escaped = np.zeros(lanes * self.classes, np.int64)
        self.lookup: np.ndarray | None = None
        self.renew()

    def renew(self) -> None:
        """Frequencies from what has been seen: `plan` holds start and width, of 4096, of each outcome in each cell."""
        seen = self.seen.reshape(self.lanes, 4, 4, 2, 3).astype(np.int64)
        trials = seen.sum(axis=4)
        right2 = seen[..., 0]
        right1 = seen[..., 1].copy()
        right1[..., 1] += right2[..., 1]
        start = np.array([300, 1200, 2200, 3300])
        p2 = (4096 * right2.sum(axis=(2, 3)) + 8 * start) // (trials.sum(axis=(2, 3)) + 8)
        p1 = (4096 * right1.sum(axis=(1, 3)) + 8 * start) // (trials.sum(axis=(1, 3)) + 8)
        s2 = _STRETCH[np.minimum(p2, 4095)][:, :, None, None]
        s1 = _STRETCH[np.minimum(p1, 4095)][:, None, :, None] * np.array([-1, 1])  # order 1 speaks against another candidate
        w2, w1 = (self.weights[:, None, None, :, i] for i in (0, 1))
        mixed = _SQUASH[np.clip(w2 * s2 + w1 * s1 >> 16, -2047, 2047) + 2048]
        error = 4096 * right2 - trials * mixed
        total = trials.sum(axis=(1, 2))[..., None] + 1
        step = np.stack([(error * s2).sum(axis=(1, 2)), (error * s1).sum(axis=(1, 2))], axis=-1)
        self.weights = np.clip(self.weights + (step // total >> 6), -65536, 131072)
        hit2 = np.clip((4096 * right2 + 12 * mixed) // (trials + 12), 1, 4000)
        left = 4096 - hit2
        hit1 = np.minimum(left * (4096 * seen[..., 1] + 12 * p1[:, None, :, None]) // (4096 * (trials - right2 + 12)) + 1, left - 8)
        hit1[..., 1] = 0
        self.plan = np.empty((self.lanes, 4, 4, 2, 3), np.uint32)
        self.plan[..., 0], self.plan[..., 1], self.plan[..., 2] = hit2, hit2 << 16 | hit1, (hit2 + hit1) << 16 | left - hit1
        self.plan = self.plan.reshape(-1)
        shares = self.shares + 16 * self.escaped.reshape(self.lanes, -1)
        part = 1 + shares * ((1 << _SHARE) - self.classes) // shares.sum(axis=1)[:, None]
        part[:, 0] += (1 << _SHARE) - part.sum(axis=1)
        self.width = part.reshape(-1)
        self.share = (np.cumsum(part, axis=1) - part << 16 | part).reshape(-1)
        if self.lookup is not None:
            self.make_lookup()

    def make_lookup(self) -> None:
        """Class at each of the 1 << _SHARE shares, for the decoder."""
        self.lookup = np.repeat(np.tile(np.arange(self.classes, dtype=np.uint8), self.lanes), self.width)

    def keep(self, n: int) -> None:
        """Go on with the first n lanes only."""
        self.base, self.cell = self.base[:, :n].copy(), self.cell[:n]

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places in the tables behind the ids a, b of all lanes, of one step or of many."""
        out = np.empty((*a.shape[:-1], 2, a.shape[-1]), np.int64)
        np.add(self.base[0], a * _MIX[0] + b * _MIX[1] >> _MIX[2], out=out[..., 0, :])
        np.add(self.base[1], b & np.uint16(self.size1 - 1), out=out[..., 1, :])
        return out

    def predict(self, places: np.ndarray) -> None:
        """Candidates and cells of all lanes."""
        self.i = places
        self.e = self.table.take(places, mode="clip")
        self.p = self.e.astype(np.uint16)
        sure = (self.e >> 16).astype(np.uint8)
        sure *= _STEPS
        sure[0] += sure[1]
        sure[0] += (self.p[0] == self.p[1]).view(np.uint8) * _AGREE
        self.k = self.cell + sure[0]

    def update(self, x: np.ndarray, right: np.ndarray) -> None:
        """x: the ids; right: whether the candidates of order 2 and 1 were."""
        e = self.e
        missed = np.where(e >= _ONE, e - _ONE, x)
        self.table[self.i] = np.where(right, np.minimum(e + _ONE, e | _FULL), missed)

    def count(self, cells: np.ndarray, escapes: np.ndarray) -> None:
        """Take down the cells with their outcome and the places of escaped classes of some steps."""
        self.seen += np.bincount(cells.ravel(), minlength=len(self.seen))
        self.escaped += np.bincount(escapes, minlength=len(self.escaped))


def _runs(sizes: list[int]) -> Iterator[tuple[int, int, int]]:
    """Begin, end and number of lanes of runs of steps; shares and weights are renewed, and lanes end, between runs only."""
    ends = set(sizes)
    begin, n = 0, len(sizes)
    for step in range(1, sizes[0] + 1 if sizes else 1):
        if step in ends or _due(step) or step - begin == _RUN:
            yield begin, step, n
            while n and sizes[n - 1] <= step:
                n -= 1
            begin = step


def _packed(words: np.ndarray) -> bytes:
    """Two words of 20 bits as five bytes."""
    pairs = np.append(words, words[:0] if len(words) % 2 == 0 else [0]).reshape(-1, 2)
    return (pairs[:, 0] << _WORD | pairs[:, 1]).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def _unpacked(parts: list[bytes]) -> np.ndarray:
    """The words of _packed() of all parts, which end with a full pair."""
    five = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 5)
    pairs = np.pad(five, ((0, 0), (3, 0))).view(">u8").ravel().astype(np.int64)
    return np.stack([pairs >> _WORD, pairs & (1 << _WORD) - 1], axis=1).ravel()


def encode_blocks(ids: np.ndarray, alphabet: int, prior: np.ndarray) -> list[bytes]:
    """Coded bytes of each block of BLOCK ids below `alphabet`, the last one shorter. prior: weights of the classes."""
    blocks = -(-len(ids) // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.uint16)
    grid.reshape(-1)[: len(ids)] = ids
    # two steps of zeros come first
    grid = np.pad(grid.T, ((2, 0), (0, 0)))
    model = _Model(blocks, alphabet, prior)
    whole = low = np.zeros(blocks, np.int64)
    span = np.full(blocks, _TOP - 1)
    # words that have left, carries still on them, and their lanes
    words: list[np.ndarray] = []
    lanes: list[np.ndarray] = []

    def shift(of: np.ndarray) -> np.ndarray:
        """The top bits of these lanes leave; their intervals after it."""
        top = low[of]
        words.append(top >> 40)
        lanes.append(of.astype(np.uint16 if blocks <= 1 << 16 else np.int64))
        low[of] = (top & (1 << 40) - 1) << _WORD
        span[of] = wide = span[of] << _WORD
        return wide

    for begin, end, n in _runs([min(BLOCK, len(ids) - i * BLOCK) for i in range(blocks)]):
        if n < len(span):
            low, span = whole[:n], span[:n]
            model.keep(n)
        if _due(begin):
            model.renew()
        # what does not hang on the models: place in the shares, bits of the class and place in the class
        before2, before1, own = (grid[begin + i : end + i, :n] for i in range(3))
        classes = _CLASS.take(own)
        place, bits, rest = classes + model.base0[:n], _BITS.take(classes), (own - _FIRST.take(classes)).astype(np.int64)
        cells, escapes = np.empty((end - begin, n), np.int64), np.empty((end - begin, n), bool)
        for row, (x, places) in enumerate(zip(own, model.places(before2, before1))):
            model.predict(places)
            right = model.p == x
            escape = np.logical_not(right[0] | right[1], out=escapes[row])
            k = np.add(model.k, (~right[0]).view(np.uint8) + escape.view(np.uint8), out=cells[row])
            plan = model.plan.take(k, mode="clip")
            part = span >> 12
            low += part * (plan >> 16)
            inside = part * (plan & 0xFFFF)
            # the escape's interval is cut for all lanes and taken by those that escape
            share = model.share.take(place[row], mode="clip")
            part = inside >> _SHARE
            more = part * (share >> 16)
            part *= share & 0xFFFF
            part >>= bits[row]
            more += part * rest[row]
            more *= escape
            low += more
            span = np.where(escape, part, inside)
            of = np.flatnonzero(span < _LOW)
            while len(of):
                of = of[shift(of) < _LOW]
            model.update(x, right)
        model.count(cells, place[escapes])
    low, span = whole, np.zeros(blocks, np.int64)
    for _ in range(3):
        shift(np.arange(blocks))
    lane = np.concatenate(lanes)
    left = np.concatenate(words)[np.argsort(lane, kind="stable")]
    # a carry goes to the word before, in the same lane: no lane's first has one
    while len(over := np.flatnonzero(left >> _WORD)):
        left[over] -= 1 << _WORD
        left[over - 1] += 1
    ends = np.cumsum(np.bincount(lane, minlength=blocks)).tolist()
    return [_packed(left[a:b]) for a, b in zip([0, *ends], ends)]
def decode_blocks(parts: list[bytes], sizes: list[int], alphabet: int, prior: np.ndarray) -> list[np.ndarray]:
    """The ids of blocks, whose sizes must not grow."""
    blocks = len(parts)
    data = _unpacked([*parts, bytes(20)]).astype(np.int32)
    at = np.concatenate([[0], np.cumsum([len(p) // 5 * 2 for p in parts])])[:-1].astype(np.int64)
    code = np.zeros(blocks, np.int64)  # the code less the interval's begin
    for _ in range(3):
        code = code << _WORD | data.take(at, mode="clip")
        at += 1
    model = _Model(blocks, alphabet, prior)
    model.make_lookup()
    span = np.full(blocks, _TOP - 1)
    grid = np.zeros((sizes[0], blocks), np.uint16)
    base = np.arange(blocks) << _SHARE
    a = b = np.zeros(blocks, np.uint16)

    for begin, end, n in _runs(sizes):
        if n < len(span):
            code, span, at, base, a, b = code[:n], span[:n], at[:n], base[:n], a[:n], b[:n]
            model.keep(n)
        if _due(begin):
            model.renew()
        base0 = model.base0[:n]
        cells, escapes, places = np.empty((end - begin, n), np.int64), np.empty((end - begin, n), bool), np.empty((end - begin, n), np.int64)
        for row in range(end - begin):
            model.predict(model.places(a, b))
            plan = model.plan.take(model.k + 1, mode="clip")  # start and width of an order-1 hit
            part = span >> 12
            right2 = code < part * (plan >> 16)
            escape = np.greater_equal(code, part * ((plan >> 16) + (plan & 0xFFFF)), out=escapes[row])
            k = np.add(model.k, (~right2).view(np.uint8) + escape.view(np.uint8), out=cells[row])
            plan = model.plan.take(k, mode="clip")
            own = code - part * (plan >> 16)
            inside = part * (plan & 0xFFFF)
            # every lane is read as an escape; those that do escape keep what comes of it
            part = inside >> _SHARE
            share = np.minimum(own.view(np.uint64) // part.view(np.uint64), np.uint64((1 << _SHARE) - 1)).view(np.int64)
            share += base
            c = model.lookup.take(share, mode="clip")
            j = np.add(base0, c, out=places[row])
            of = model.share.take(j, mode="clip")
            rest = own - part * (of >> 16)
            part *= of & 0xFFFF
            part >>= _BITS.take(c, mode="clip")
            place = (rest.view(np.uint64) // part.view(np.uint64)).view(np.int64)
            code = np.where(escape, rest - part * place, own)
            span = np.where(escape, part, inside)
            x = np.where(escape, place.astype(np.uint16) + _FIRST.take(c, mode="clip"), np.where(right2, model.p[0], model.p[1]))
            narrow = np.flatnonzero(span < _LOW)
            while len(narrow):
                where = at[narrow]
                code[narrow] = code[narrow] << _WORD | data.take(where, mode="clip")
                at[narrow] = where + 1
                span[narrow] = wide = span[narrow] << _WORD
                narrow = narrow[wide < _LOW]
            grid[begin + row, :n] = x
            model.update(x, model.p == x)
            a, b = b, x
        model.count(cells, places[escapes])
    return [grid[:size, i] for i, size in enumerate(sizes)]


def pack_section(ids: np.ndarray) -> bytes:
    """A section: head (number of ids and of blocks, the ids in order of their frequency, weights of its classes), then for each
    block its length in bytes, the CRC-32 of its ids and its coded bytes."""
    if len(ids) and int(ids.max()) > MAX_ID:
        raise ValueError(f"ids above {MAX_ID} do not fit this format")
    often = np.bincount(ids, minlength=1)
    order = np.argsort(-often, kind="stable")[: int((often > 0).sum())]
    place = np.zeros(len(often), np.uint32)
    place[order] = np.arange(len(order))
    weights = np.bincount(_CLASS[: len(order)], often[order]) if len(order) else np.ones(1)
    prior = np.maximum(1, np.round(256 * weights / weights.sum())).astype("<u2")
    parts = encode_blocks(place[ids], len(order), prior) if len(ids) else []
    plain = ids.astype("<u4")
    marks = [struct.pack("<II", len(p), zlib.crc32(plain[i * BLOCK : (i + 1) * BLOCK])) for i, p in enumerate(parts)]
    names = zlib.compress(order.astype("<u2").tobytes())
    return b"".join([MAGIC, struct.pack("<QIIII", len(ids), len(parts), len(order), len(names), len(prior)), names, prior.tobytes(), *marks, *parts])


def unpack_section(content: bytes, only: range | None = None) -> np.ndarray:
    """Ids of a section, or of some of its blocks, in order; a block whose checksum does not fit stops the read."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("no token section")
    total, blocks, alphabet, size, classes = struct.unpack_from("<QIIII", content, len(MAGIC))
    at = len(MAGIC) + 24
    order = np.frombuffer(zlib.decompress(content[at : at + size]), "<u2")
    prior = np.frombuffer(content, "<u2", classes, at + size)
    at += size + 2 * classes
    marks = np.frombuffer(content, "<u4", 2 * blocks, at).reshape(-1, 2)
    begins = at + 8 * blocks + np.concatenate([[0], np.cumsum(marks[:, 0], dtype=np.int64)])
    wanted = range(blocks)[only.start : only.stop] if only else range(blocks)
    if not wanted:
        return np.empty(0, "<u4")
    found = decode_blocks([content[begins[i] : begins[i + 1]] for i in wanted], [min(BLOCK, total - i * BLOCK) for i in wanted], alphabet, prior)
    out = []
    for i, places in zip(wanted, found):
        ids = order.take(places, mode="clip").astype("<u4")
        if zlib.crc32(ids) != marks[i, 1]:
            raise ValueError(f"damaged block {i}")
        out.append(ids)
    return np.concatenate(out)


class LibraryEncoder:
    """Ids by the tokenizers library. Parts of a text between single spaces do not depend on each other, so that the
    library is asked once for each part and its ids are remembered."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {"": b""}
        size = self.library.get_vocab_size(with_added_tokens=True)
        if size > MAX_ID + 1:
            raise ValueError(f"ids above {MAX_ID} do not fit this format")
        self.begins = np.array([str(self.library.id_to_token(i)).startswith("\u0120") for i in range(size)])
        self.line_end = self.library.token_to_id("\u010a")
        self.line = np.array([self.line_end or 0], "<u2").tobytes()
        self.plain = self.line_end is not None and self._cuts_words(json.loads(content))
        self.model, self.letters = self.library.model, dict(enumerate(byte_letters()))

    @staticmethod
    def _cuts_words(spec: dict) -> bool:
        """Whether letters, with a space before them or not, and marks behind them are a word each to this vocabulary, whose bytes
        go to the model as letters; no added token may stand inside."""
        cut = spec.get("pre_tokenizer") or {}
        bytewise = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        added = [t["content"] for t in spec.get("added_tokens") or []]
        return bool(bytewise and spec["model"].get("type") == "BPE" and not spec.get("normalizer") and all(map(_MARK_LETTER.search, added)))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words by the library's model alone; each is one word to the library's cut and holds no line end."""
        ask = self.model.tokenize
        for at in range(0, len(words), 4096):
            some = "\n".join(words[at : at + 4096]).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
            yield from (array("H", [t.id for t in ask(w)]).tobytes() for w in some)

    def _ask(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of every part with a space before it, and of words found in them. Lines of letters with marks behind them are cut
        here, and the library's model is asked for letters and marks that are not known."""
        out: dict[str, bytes] = {}
        if not self.plain:
            return self._ask_whole(out, parts)
        lines = {p: q for p in parts if "\n" in p and all(map(_LINE.fullmatch, q := p.split("\n")))}
        known = self._known([q[0] for q in lines.values()])
        asked = list({*parts, *(q[0] for q in lines.values())} - known.keys())
        out.update(known)
        stems = [p.rstrip(_MARKS) for p in asked]
        alone = [s.isalpha() and (s.isascii() or max(s) < _LETTERS_END) for s in stems]
        cut = [(p, s) for p, s, a in zip(asked, stems, alone) if a and len(s) < len(p)]
        out.update(self._known([s for _, s in cut]))
        words = list({s for s, a in zip(stems, alone) if a and s not in out})
        out.update(zip(words, self._words([" " + w for w in words])))
        # marks, and what begins a line, have no space before them
        later = {p: [(s := x.rstrip(_MARKS), x[len(s) :]) for x in q[1:]] for p, q in lines.items()}
        if len(self.bare) > MEMO:
            self.bare = {"": b""}
        bare = list(({p[len(s) :] for p, s in cut} | {w for q in later.values() for pair in q for w in pair}) - self.bare.keys())
        self.bare.update(zip(bare, self._words(bare)))
        ids = self.bare
        out.update((p, out[s] + ids[p[len(s) :]]) for p, s in cut)
        out.update((p, out[lines[p][0]] + b"".join([self.line + ids[s] + ids[m] for s, m in q])) for p, q in later.items())
        return self._ask_whole(out, [p for p, a in zip(asked, alone) if not a and p not in lines])

    def _known(self, parts: list[str]) -> dict[str, bytes]:
        """Those parts that are remembered."""
        return {p: i for p in parts if (i := self.memo.get(p) or self.old.get(p)) is not None}

    def _ask_whole(self, out: dict[str, bytes], parts: list[str]) -> dict[str, bytes]:
        """Parts are joined and cut again where a token begins with a space, which within a part no token does; parts with a space
        inside or white space at an end are asked for one by one."""
        single = [p for p in parts if p and " " not in p and not p[0].isspace() and not p[-1].isspace()]
        for at in range(0, len(single), 4096):
            some = single[at : at + 4096]
            ids = self._ids(" " + " ".join(some))
            self._cut(out, some, ids, np.flatnonzero(self.begins[ids]), 0)
        out.update((p, self._ids(" " + p).tobytes()) for p in parts if p not in out)
        return out

    def _heads(self, heads: list[str]) -> list[bytes]:
        """Ids of the first part of each text, asked for as lines."""
        out: dict[str, bytes] = {"": b""}
        single = [h for h in {*heads} if h and not _SPACE.search(h)]
        if single:
            ids = self._ids("\n" + "\n".join(single))
            self._cut(out, single, ids, np.flatnonzero(ids == self.line_end), 1)
        return [out[h] if h in out else self._ids(h).tobytes() for h in heads]

    @staticmethod
    def _cut(out: dict[str, bytes], parts: list[str], ids: np.ndarray, starts: np.ndarray, skip: int) -> None:
        """Give each part its ids if there are as many starts as parts; else none, and they are asked for alone."""
        if len(starts) == len(parts):
            raw, cuts = ids.tobytes(), [*(2 * starts).tolist(), 2 * len(ids)]
            out.update((p, raw[a + 2 * skip : b]) for p, a, b in zip(parts, cuts, cuts[1:]))

    def _remembered(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts with a space before them."""
        known = list(map(self.memo.get, parts))
        if missing := [p for p, i in zip(parts, known) if i is None]:
            new = {p: i for p, i in zip(missing, map(self.old.get, missing)) if i is not None}
            new.update(self._ask([p for p in missing if p not in new] if new else missing))
            if len(self.memo) + len(new) > MEMO:
                self.old, self.memo = self.memo, {}
            self.memo.update(new)
            known = [new[p] if i is None else i for p, i in zip(parts, known)]
        return known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind another, and the number of each text's; there are no nulls. Arrow cuts the texts and
        finds their distinct parts."""
        cut = pc.split_pattern(texts, " ")
        wide = np.flatnonzero(pc.match_substring_regex(texts, _WIDE).to_numpy(zero_copy_only=False))
        if len(wide):  # these are cut where the space stands alone
            own = {int(i): _SAFE_SPACE.split(texts[int(i)].as_py()) for i in wide}
            counts = pc.list_value_length(cut).to_numpy().astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            pieces, before = [], 0
            for i, parts in own.items():
                pieces += [cut.values.slice(bounds[before], bounds[i] - bounds[before]), pa.array(parts, cut.values.type)]
                counts[i], before = len(parts), i + 1
            words = pa.concat_arrays([*pieces, cut.values.slice(bounds[before])])
        else:
            counts, words = pc.list_value_length(cut).to_numpy().astype(np.int64), cut.values
        coded = words.dictionary_encode()
        distinct = self._remembered(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # the first part of a text has no space before it
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        heads = self._heads(words.take(pa.array(first)).to_pylist())
        which = coded.indices.to_numpy().astype(np.int64)
        which[first] = len(distinct) + np.arange(len(heads))
        distinct += heads
        found = pa.array(distinct, pa.large_binary()).take(pa.array(which))
        each = pc.binary_length(found).to_numpy() // 2
        ids = np.frombuffer(found.buffers()[2] or b"", "<u2", int(each.sum()))
        lengths = np.add.reduceat(each, first) if len(first) else each
        return ids, lengths


def _encoder_of(content: bytes) -> LibraryEncoder:
    """One encoder, with what it remembers, for each worker and vocabulary."""
    return kept_by_worker(("library", hash(content)), lambda: LibraryEncoder(content))


_SECTION_SCHEMA = "part int, before long, ids array<{kind}>, lengths array<long>, payload binary"


def _portions(batch: pa.RecordBatch, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about `size` bytes of text, of at least one row each."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of all texts, each with `end_id` behind it, in ascending order of `id_col`, as sections of about
    SECTION ids. A row of the table is a section: the part it belongs to, the ids before it in that part, the documents
    and their numbers of ids, and the coded bytes.

    Null texts count as empty (the end id alone). Null ids come first; rows that share an id stand in order of their
    texts. Other columns, whatever their names, are not read. Parts are ranges of `id_col`, sorted on executors.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(tokenizer or vocabulary_path()).read_bytes())
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranged = base.repartitionByRange(shuffle_partitions(spark), F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library, part = _encoder_of(content.value), TaskContext.get().partitionId()
        keys: list[pa.Array] = []
        coded: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        before = 0

        def section() -> pa.RecordBatch:
            nonlocal before
            ids, own, each = np.concatenate(coded), pa.concat_arrays(keys), np.concatenate(lengths)
            lists = (pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), v) for v in (own, pa.array(each, pa.int64())))
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([before], pa.int64()), *lists, pa.array([pack_section(ids)], pa.binary())], names=["part", "before", "ids", "lengths", "payload"])
            before += len(ids)
            for held in (keys, coded, lengths):
                held.clear()
            return row

        for batch in batches:
            for few in _portions(batch):
                ids, each = library.encode(few.column(1))
                # the end id behind each text
                coded.append(np.insert(ids, np.cumsum(each), end_id))
                lengths.append(each + 1)
                keys.append(few.column(0))
                if sum(map(len, coded)) >= SECTION:
                    yield section()
        if coded:
            yield section()

    ranged.mapInArrow(run, _SECTION_SCHEMA.format(kind=kind)).write.mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """A row per document: id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, tokens.

    The cases of write_tokens() hold: null texts have the end id alone, null and repeated ids have a row each, a file
    without documents gives no rows. A damaged block stops the read.
    """
    sections = spark.read.parquet(path)
    kind = sections.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, keys, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack_section(payload)
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array([part] * len(keys), pa.int32()), pa.array(keys, batch.schema.field("ids").type.value_type), pa.array(starts + before, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), pa.array(ids.astype(np.int64), pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["part", "id", "rel", "n_tokens", "ids_crc32", *(["tokens"] if with_ids else [])])

    docs = sections.select("part", "before", "ids", "lengths", "payload").mapInArrow(run, f"part int, id {kind}, rel long, n_tokens long, ids_crc32 long" + ", tokens array<long>" * with_ids)
    # one row per part of the file, as many as there are shuffle partitions
    sizes = sections.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    offsets = sizes.withColumn("offset", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", F.coalesce("offset", F.lit(0).cast("long")).alias("offset"))
    out = docs.join(F.broadcast(offsets), "part")
    return out.select("id", (F.col("offset") + F.col("rel")).alias("start"), "n_tokens", "ids_crc32", *(["tokens"] if with_ids else []))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, read back from the file; the cases of write_tokens() hold."""
    path = staging_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, with_ids=False).withColumnRenamed("id", "doc_id")
