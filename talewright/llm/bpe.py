"""Byte-level BPE on a contiguous rank array, and its inverse."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_by_worker, modest_batches, table

#: Fixed value: the pattern that cuts a text into words before merging.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Words of more bytes than this are merged with a heap; the scan is for short ones.
SHORT = 256
#: Entries of one generation of what a worker remembers. When it is full it becomes the old one, and what is still in use
#: is taken over from there; this bounds memory and changes no result.
MEMO = 100_000
_DOUBLE_SPACE = re.compile(r"\s\s")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_NONE = 1 << 60


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def chunks_of(text: str) -> list[str]:
    """Cut a text at single spaces so that the words of each part do not depend on the others. The space before each
    part but the first belongs to that part and is left out here."""
    return text.split(" ") if not _DOUBLE_SPACE.search(text) else _SAFE_SPACE.split(text)


class Memo:
    """Two generations of values by key."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def find(self, key: str) -> bytes | None:
        """The value of a key that is not among the young."""
        found = self.old.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Codec:
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in vocab.items():
            self.token_bytes[i] = t.encode() if t in self.special else bytes(map(to_byte.__getitem__, t))
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        self.byte_ids = [vocab[c] for c in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.names = [str(i) for i in range(len(self.token_bytes))]
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # ids are remembered as the bytes of small unsigned numbers
        self.dtype = "<u2" if len(self.token_bytes) <= 1 << 16 else "<u4"
        self._words, self._chunks = Memo(MEMO // 2), Memo(MEMO)

    def _merge_short(self, word: bytes) -> list[int]:
        """Scan the array of adjacent ranks for its minimum, delete that boundary, refresh both neighbours."""
        parts = [self.byte_ids[b] for b in word]
        rank = self.ranks.get
        ranks = [rank(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < _NONE:
            at = ranks.index(least)
            parts[at : at + 2] = [new] = [self.merged[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 20 | new, _NONE)
            if at < len(ranks):
                ranks[at] = rank(new << 20 | parts[at + 1], _NONE)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        """The same merges from a heap of (rank, place), for words too long to scan again and again."""
        parts: list[int] = [self.byte_ids[b] for b in word]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] << 20 | parts[i + 1], _NONE)) < _NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= len(parts) or self.ranks.get(parts[i] << 20 | parts[j]) != r:
                continue
            parts[i], parts[j], after[i] = self.merged[r], -1, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (new := self.ranks.get(parts[a] << 20 | parts[b], _NONE)) < _NONE:
                    heapq.heappush(heap, (new, a))
        return [p for p in parts if p >= 0]

    def _packed(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype == "<u2" else "I", ids).tobytes()

    def _word(self, word: str) -> bytes:
        found = self._words.young.get(word)
        if found is None and (found := self._words.find(word)) is None:
            raw = word.encode("utf-8")
            found = self._packed(self._merge_short(raw) if len(raw) <= SHORT else self._merge_long(raw))
            if len(raw) <= SHORT:
                self._words.keep(word, found)
        return found

    def _words_of(self, part: str) -> bytes:
        return b"".join(map(self._word, WORDS.findall(part)))

    def _chunk(self, chunk: str) -> bytes:
        found = self._chunks.find(chunk)
        if found is None:
            found = self._words_of(" " + chunk)
            if len(chunk) <= SHORT:
                self._chunks.keep(chunk, found)
        return found

    def _plain(self, text: str) -> bytes:
        chunks = chunks_of(text)
        found = list(map(self._chunks.young.get, chunks))
        found[0] = self._words_of(chunks[0])
        if None in found:
            found = [self._chunk(c) if f is None else f for c, f in zip(chunks, found)]
        return b"".join(found)

    def encode_array(self, text: str) -> np.ndarray:
        """Ids of a text; a special token's own string stands for that token, as in the library."""
        if not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), self.dtype)
        parts = (self._packed([self.special[p]]) if p in self.special else self._plain(p) if p else b"" for p in self._cut.split(text))
        return np.frombuffer(b"".join(parts), self.dtype)

    def encode(self, text: str) -> list[int]:
        return self.encode_array(text).tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def codec_of(content: bytes) -> Codec:
    """One codec per worker and vocabulary."""
    return kept_by_worker(("bpe", hash(content)), lambda: Codec(content))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most `rows` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _content(spark: SparkSession, path: str | None):
    """The vocabulary file (a few MB at most) is read once by the driver and sent to every executor."""
    content = Path(path or vocabulary_path()).read_bytes()
    if len(content) > 64 << 20:
        raise ValueError("vocabulary file of over 64 MB")
    return spark.sparkContext.broadcast(content)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array<int>).

    The ids are decoded again for decoded_sha256. Null texts count as empty: no ids, digests of nothing. Repeated
    rows and null or repeated ids give a row each; other columns, whatever their names, are not read. No shuffle;
    whole texts, a batch at a time.
    """
    modest_batches(docs.sparkSession)
    sent = _content(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(sent.value)
        name = codec.names.__getitem__
        for batch in slices(batches):
            counts, digests, back, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                packed = codec.encode_array(text or "")
                ids = packed.tolist()
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
                if with_ids:
                    kept.append(pa.array(packed.astype(np.int32)))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = pa.array([0, *counts], pa.int64()).to_numpy().cumsum()
                flat = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Texts of id lists: id, text. A null list is an empty text; bytes that are not UTF-8 become U+FFFD."""
    sent = _content(tokens.sparkSession, path)
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(sent.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), with_ids=False)
