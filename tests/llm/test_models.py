"""Toxicity, BPE, media, token files, near-duplicates and repeated passages."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talewright.llm import bpe, jpeg, minhash, suffix, tokenfile, toxicity
from talewright.llm.common import staging_path
from talewright.llm.common import Workspace
from talewright.llm.components import components

from .test_native import frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


ODD = [None, "", " ", "  a  b ", "a\n\n b\t c", "it's <|endoftext|> we'll", "<|endoftext|>", " <|endoftext|>x", "naïve 東京 😀😀 ½²", "x" * 5000, "ab" * 3000, " " * 3000, "   a\x1c\x1fb\x85c", "1234567 don't", "a\r\nb\x00c"]


# ---------------------------------------------------------------- toxicity


def test_subsequence_kernel():
    """The kernel is the inner product of explicit gap-weighted subsequences."""

    def explicit(word):
        out, w = Counter(), "\x01" + word
        for i in range(len(w)):
            for a, b in toxicity._PATTERNS:
                if i + b < len(w) and all(c.isalpha() or c == "\x01" for c in (w[i], w[i + a], w[i + b])):
                    out[w[i], w[i + a], w[i + b]] += toxicity.DECAY ** (b - 2)
        return out

    words = ["stupid", "st-upid", "idiot", "aaaaaa", "ab", "x"]
    marks = toxicity.Landmarks.of(words)
    got = toxicity.kernel(words, marks)
    full = [explicit(w) for w in words]
    dot = lambda a, b: sum(v * b[k] for k, v in a.items())
    for i, a in enumerate(full):
        for j, b in enumerate(full):
            want = dot(a, b) / ((dot(a, a) or 1) * (dot(b, b) or 1)) ** 0.5
            assert abs(got[i, j] - want) < 1e-5
    beta = marks.table(np.arange(1.0, 7.0))
    want = got @ np.arange(1.0, 7.0)
    assert np.allclose(toxicity.folded(words, beta, 0.0), np.where(want > 0, want, -1), atol=1e-4)
    assert np.allclose(toxicity.weights_of(words, beta, toxicity.self_kernel(words)), want, atol=1e-4)


def test_toxicity(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeghlnorst") for _ in range(rng.randint(2, 8)))
    bad = ["zwirk", "moxtle", "quibfy"]
    rows = []
    for i in range(900):
        words = [word() for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for b in rng.sample(bad, 2):
                words.insert(rng.randrange(len(words)), rng.choice([b, b, b + "!", b.upper()]))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == rows[i][2] for i in held) / len(held) > 0.95
    odd = frame(spark, [None, "", "..", "you m.o.x.t.l.e z.w.i.r.k", "moxxtle zwiirk", "a b c", "\x01" * 9, "z w i r k m o x t l e"])
    rows = toxicity.score(odd, model).orderBy("doc_id").collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[3]["score"] > rows[5]["score"] and rows[4]["score"] > rows[5]["score"] and rows[0]["predicted"] == 0
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_toxicity_query(spark):
    """Held-out rows are those of the contract, none of them is learned from, and most of them are told apart."""
    got = {r["doc_id"]: r for r in toxicity.op3_toxicity(spark, SF.replace("0.001", "0.01")).collect()}
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [i for i in labels if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == labels[i] for i in held) >= 0.9 * len(held)
    rank = [got[i]["score"] - got[j]["score"] for i in held for j in held if labels[i] > labels[j]]
    assert np.mean([(d > 0) + (d == 0) / 2 for d in rank]) > 0.8
    # a held-out label changes nothing
    other = spark.createDataFrame([(i, 1 - y if got[i]["held_out"] else y) for i, y in labels.items()], "doc_id long, toxic int")
    a, b = (toxicity.fit(docs, x) for x in (spark.createDataFrame([*labels.items()], "doc_id long, toxic int"), other))
    assert np.array_equal(a.beta, b.beta) and a.link == b.link


def test_toxicity_without_labels(spark):
    docs = frame(spark, ["a", None])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score(docs, model).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    one_class = toxicity.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score(docs, one_class).collect()} == {0}


# ---------------------------------------------------------------- BPE and token files


def test_bpe_equals_library(spark, library):
    rng = random.Random(2)
    letters = list(" \n\tabcTHE'12é½عא中文😀!<>|_-\x00") + ["<|endoftext|>", "'ll", " the", "  "]
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(300)]
    got = bpe.encode(frame(spark, texts)).orderBy("doc_id").collect()
    for text, r in zip(texts, got):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(frame(spark, texts))).orderBy("doc_id").collect()
    assert [r["text"] for r in back] == [t or "" for t in texts]
    assert bpe.encode(frame(spark, texts).limit(0)).count() == 0


def test_short_and_long_words_agree():
    codec = bpe.Codec(open(bpe.vocabulary_path(), "rb").read())
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choices("etaoinshr ab", k=rng.randint(1, 80))).encode()
        assert codec._merge_short(word) == codec._merge_long(word)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
def test_sections(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), rng.integers(0, 4, n), np.full(n, 65535), np.arange(n) % 7):
        content = tokenfile.pack_section(ids.astype("<u2"))
        assert (tokenfile.unpack_section(content) == ids).all()
        if n > 128:
            broken = bytearray(content)
            broken[len(tokenfile.MAGIC) + 20] ^= 1
            with pytest.raises(ValueError):
                tokenfile.unpack_section(bytes(broken))
    with pytest.raises(ValueError):
        tokenfile.pack_section(np.array([1 << 16]))


def test_repetition_is_cheap():
    assert len(tokenfile.pack_section(np.tile(np.arange(5), 4000))) < 20000 * 2 / 3


def test_smaller_than_zlib(spark):
    """Ids of real texts take less than a byte each, and less than zlib's strongest setting needs for them as they stand."""
    texts = [r["text"] or "" for r in spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet").orderBy("doc_id").collect()]
    ids, lengths = tokenfile.LibraryEncoder(open(bpe.vocabulary_path(), "rb").read()).encode(pa.array(texts))
    content = tokenfile.pack_section(ids)
    assert len(lengths) == len(texts) and lengths.sum() == len(ids)
    assert len(content) < min(len(ids), len(zlib.compress(ids.tobytes(), 9)))
    assert (tokenfile.unpack_section(content) == ids).all()
    # blocks stand alone
    assert (tokenfile.unpack_section(content, range(3, 5)) == ids[3 * tokenfile.BLOCK : 5 * tokenfile.BLOCK]).all()


def test_known_words_are_not_asked_for_again(library):
    """Marks behind a word and line ends inside a part cost no new look at letters that are known; ids stay the library's."""
    encoder = tokenfile.LibraryEncoder(open(bpe.vocabulary_path(), "rb").read())
    asked = []

    class Model:
        def tokenize(self, word, real=encoder.model):
            asked.append(word)
            return real.tokenize(word)

    encoder.model = Model()
    encoder.encode(pa.array(["a zebra été"]))
    assert sorted(asked) == ["\u0120a", "\u0120zebra", "\u0120Ã©tÃ©"]
    encoder.encode(pa.array(["a zebra, zebra!? été.\nThen"]))
    assert sorted(asked[3:]) == ["!?", ",", ".", "Then"]
    rng = random.Random(11)
    letters = ["ab", "Zoë", "don", "t", "s", "'", "'s", ".", ",", "\n", "\n", " ", " ", " ", "7", "ß", "\u0250", "×", "ª", "\u00a0", "\t", "<|endoftext|>", "<|", "|>", "日本", "é"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2000)]
    ids, lengths = encoder.encode(pa.array(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_token_files(spark, library):
    path = staging_path(spark, "tokens")
    texts = ODD + ["the same"] * 3
    ids = [9, 3, 40, 2, *range(100, 100 + len(texts) - 4)]
    tokenfile.write_tokens(frame(spark, texts, ids), path)
    got = tokenfile.read_tokens(spark, path).orderBy("id").collect()
    start = 0
    for i, text in sorted(zip(ids, texts)):
        r = got.pop(0)
        want = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r["id"], r["start"], r["n_tokens"], r["tokens"]) == (i, start, len(want), want)
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    empty = staging_path(spark, "tokens")
    tokenfile.write_tokens(frame(spark, texts).limit(0), empty)
    assert tokenfile.read_tokens(spark, empty).count() == 0


# ---------------------------------------------------------------- media


def test_media_round_trip(spark, tmp_path):
    texts = [None, "", "a", "é" * 32, "x" * 64, "y" * 65, "long text " * 5000, "a", "\x00\x7f"]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = jpeg.op6_media(spark, str(tmp_path)).orderBy("doc_id").collect()
    for text, r in zip(texts, got):
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert tuple(got[2])[1:] == tuple(got[7])[1:]
    media = jpeg.encode_media(frame(spark, texts))
    tensor = jpeg.decode_media(media).where("doc_id = 6").first()
    assert len(tensor["tensor"]) == 3 * tensor["height"] * tensor["width"] and media.limit(0).count() == 0
    assert jpeg.decode_media(media.withColumn("media", F.lit(None).cast("binary"))).where("media_bytes IS NOT NULL").count() == 0


def test_bytes_of_all_kinds():
    rng = np.random.default_rng(5)
    payloads = [rng.integers(a, b, 64 * n, dtype=np.uint16).astype(np.uint8).tobytes() for a, b, n in ((0, 256, 1), (0, 256, 37), (250, 256, 50), (255, 256, 9), (0, 1, 3))]
    for p, (image, coef, rgb) in zip(payloads, jpeg.decode_images(jpeg.encode_payloads(payloads))):
        assert jpeg.stored_payload(image, coef) == p and rgb.shape == (image.height, image.width, 3)


def test_another_reader_agrees(spark):
    """The virtual machine's own JPEG reader sees the same lightness, within the rounding of its transform."""
    jvm = spark._jvm
    rng = np.random.default_rng(6)
    payloads = [b"plain text in a picture ".ljust(64, b"\0") * 7, rng.integers(0, 256, 64 * 29, dtype=np.uint16).astype(np.uint8).tobytes(), bytes(64)]
    files = jpeg.encode_payloads(payloads)
    images, coef = jpeg.read_coefficients(files)
    for im, content in zip(images, files):
        reader = jvm.javax.imageio.ImageIO.getImageReadersByFormatName("jpeg").next()
        reader.setInput(jvm.javax.imageio.ImageIO.createImageInputStream(jvm.java.io.ByteArrayInputStream(content)))
        raster = reader.readRaster(0, None)
        assert (raster.getHeight(), raster.getWidth()) == (im.height, im.width)
        theirs = np.array(list(raster.getSamples(0, 0, im.width, im.height, 0, spark.sparkContext._gateway.new_array(jvm.int, im.width * im.height)))).reshape(im.height, im.width)
        rows, columns = im.grids[0]
        ours = jpeg.samples(coef[im.starts[0] : im.starts[1]], im.quantisers[0]).reshape(rows, columns, 8, 8).swapaxes(1, 2).reshape(8 * rows, 8 * columns)
        assert np.abs(ours[: im.height, : im.width].astype(int) - theirs).max() <= 2


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, n):
        self.text += format(value, f"0{n}b") if n else ""

    def done(self):
        text = self.text + "1" * (-len(self.text) % 8)
        return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8)).replace(b"\xff", b"\xff\x00")


def test_general_progressive_stream():
    """A grey image with zero runs, end-of-band runs, negative values and refined new coefficients."""
    rng = np.random.default_rng(8)
    blocks = np.zeros((6, 64), int)
    for b in (0, 1, 4):
        at = rng.choice(np.arange(1, 64), 9, replace=False)
        blocks[b, at] = rng.integers(-9, 10, 9)
        blocks[b, 0] = rng.integers(-200, 200)
    blocks[4, 63] = 1
    code = lambda s: (s, 8)  # noqa: E731  every symbol is its own eight-bit code
    table = lambda kind: jpeg._segment(0xFFC4, bytes([kind << 4, *[0] * 7, 255, *[0] * 8, *range(255)]))
    size = lambda v: int(abs(v)).bit_length()
    bits_of = lambda v, n: v if v > 0 else v + (1 << n) - 1

    def scan(first, last, high, low, body):
        return jpeg._scan_head(1, first, last, high, low, 0, 0) + body.done()

    dc, before = Bits(), 0
    for b in blocks:
        d = (int(b[0]) >> 1) - before
        before += d
        dc.put(*code(size(d)))
        dc.put(bits_of(d, size(d)), size(d))
    dc2 = Bits()
    for b in blocks:
        dc2.put(int(b[0]) & 1, 1)
    ac, run = Bits(), 0

    def flush(out, run):
        if run:
            n = run.bit_length() - 1
            out.put(*code(n << 4))
            out.put(run - (1 << n), n)

    for b in blocks:
        zeros = 0
        for v in (int(np.sign(x) * (abs(x) >> 1)) for x in b[1:]):
            if not v:
                zeros += 1
                continue
            flush(ac, run)
            run = 0
            while zeros > 15:
                ac.put(*code(0xF0))
                zeros -= 16
            ac.put(*code(zeros << 4 | size(v)))
            ac.put(bits_of(v, size(v)), size(v))
            zeros = 0
        run += zeros > 0
    flush(ac, run)
    fine, run, held = Bits(), 0, []
    for b in blocks:
        zeros, late = 0, []
        for x in map(int, b[1:]):
            if abs(x) >> 1:
                late.append(abs(x) & 1)
            elif x:
                flush(fine, run)
                run = 0
                for bit in held:
                    fine.put(bit, 1)
                held = []
                while zeros > 15:
                    # corrections up to the sixteenth zero belong to this symbol; this image has none between
                    fine.put(*code(0xF0))
                    zeros -= 16
                fine.put(*code(zeros << 4 | 1))
                fine.put(int(x > 0), 1)
                for bit in late:
                    fine.put(bit, 1)
                zeros, late = 0, []
            else:
                zeros += 1
                if zeros == 16 and late and any(abs(int(y)) == 1 for y in b[1:]):
                    pass
        run, held = run + 1, held + late
    flush(fine, run)
    for bit in held:
        fine.put(bit, 1)
    frame_head = jpeg._segment(0xFFC2, bytes([8, 0, 16, 0, 24, 1, 1, 0x11, 0]))
    for with_refinement in (False, True):
        content = b"\xff\xd8" + jpeg._segment(0xFFDB, bytes([0, *[1] * 64])) + frame_head + table(0) + table(1) + scan(0, 0, 0, 1, dc) + scan(0, 0, 1, 0, dc2) + scan(1, 63, 0, 1, ac)
        want = blocks.copy()
        want[:, 1:] = np.sign(want[:, 1:]) * (abs(want[:, 1:]) >> 1 << 1)
        if with_refinement and not _splits_a_long_run(blocks):
            content += scan(1, 63, 1, 0, fine)
            want = blocks
        _, coef = jpeg.read_coefficients([content + b"\xff\xd9"])
        assert (coef == want).all()


def _splits_a_long_run(blocks):
    """Whether a new coefficient stands behind sixteen zeros with older coefficients between, which the test's writer does not do."""
    for b in blocks:
        zeros = old = 0
        for x in map(int, b[1:]):
            if abs(x) >> 1:
                old += 1
            elif x:
                if zeros > 15 and old:
                    return True
                zeros = old = 0
            else:
                zeros += 1
    return False


# ---------------------------------------------------------------- components and near-duplicates


def unions(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(7, 7), (1, 0)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long"), Workspace(spark, "t")).collect()}
    want = unions({n for e in edges for n in e}, edges)
    assert {n: got.get(n, n) for n in want} == want
    assert components(spark.createDataFrame([], "u long, v long"), Workspace(spark, "t")).count() == 0


def near_of(texts, ids, width=4):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", w) if x]
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    edges = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = unions(set(ids), edges)
    return [(i, len(s), root[i], root[i] == i) for i, s in zip(ids, sets)]


@pytest.mark.parametrize("tile", [1024, 8])
def test_near_duplicates(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "MEMBERS", 5)
    rng = random.Random(11)
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 120))] for _ in range(12)]
    texts = [None, "", "one", "ONE", "one two", "a b c", "\t a b c d  e "]
    for b in base:
        for _ in range(9):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(99))
            texts.append(" ".join(w))
    chain = [f"c{i}" for i in range(60)]
    texts += [" ".join(chain[i : i + 40]) for i in range(0, 20, 2)]  # each is alike to its neighbours only
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    got = {r["doc_id"]: tuple(r) for r in minhash.near_duplicates(frame(spark, texts, ids), width=4).collect()}
    assert [got[i] for i in ids] == near_of(texts, ids)
    kept = minhash.drop_near_duplicates(frame(spark, texts, ids), width=4)
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(i for i in ids if got[i][3]) and kept.columns == frame(spark, texts).columns


def test_members_stand_once_in_a_star(spark, monkeypatch):
    """Texts that are near, many of them under the threshold, share many bands; what is left open is no row for each band."""
    rows, tiles = [], minhash._tiles
    monkeypatch.setattr(minhash, "_tiles", lambda members, work: rows.append((members.count(), members.select("c").distinct().count())) or tiles(members, work))
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(60):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([2, 3, 4, 5])):
            w[at] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: tuple(r) for r in minhash.near_duplicates(frame(spark, texts, ids), width=4).collect()}
    assert [got[i] for i in ids] == near_of(texts, ids) and len({r[2] for r in got.values()}) > 5
    assert rows[0][1] > 40 and rows[0][0] <= 8 * rows[0][1]


def test_near_duplicates_odd_ids(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "p q r s t u"), (9, "p q r s t u"), (5, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (9, 2, 5, False), (5, 2, 5, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_odd_sketch_estimates():
    rng = np.random.default_rng(12)
    for share in (0.95, 0.8, 0.3):
        common = rng.integers(1, 1 << 63, int(3000 * share), dtype=np.uint64)
        own = [rng.integers(1, 1 << 63, (3000 - len(common)) // 2, dtype=np.uint64) for _ in range(2)]
        a, b = (minhash.odd_sketch(minhash.minima(np.unique(np.concatenate([common, o])))) for o in own)
        differing = int(minhash._differing(a[None, :], b[None, :])[0, 0])
        assert differing == sum(bin((int(x) ^ int(y)) & (1 << 64) - 1).count("1") for x, y in zip(a, b))
        assert (differing <= minhash.SKETCH_LIMIT) == (share >= 0.8)


# ---------------------------------------------------------------- repeated passages


def repeats_of(texts, window=200):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, int)
        for i in range(len(r) - window + 1):
            if count[r[i : i + window]] > 1:
                gone[i] += 1
                gone[i + window] -= 1
        gone = np.cumsum(gone)[: len(r)] > 0
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [4096, 12])
def test_repeats(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix, "SHARD", shard)
    monkeypatch.setattr(suffix, "MERGE", 300)
    monkeypatch.setattr(suffix, "AT_ONCE", 4000)
    rng = random.Random(13)
    noise = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    line, texts = noise(260), [None, "", "z" * 199, "z" * 200, "y" * 201, "y" * 777, "ab" * 300, "é" * 100, "é" * 150]
    for i in range(120):
        t = noise(rng.randrange(700))
        if i % 3:
            t = t[: rng.randrange(len(t) + 1)] + line[rng.randrange(20) : rng.randrange(180, 261)] + noise(rng.randrange(300))
        texts.append(t)
    texts += [texts[30], texts[30], texts[31][:50] + texts[31][:50]]
    got = suffix.repeated_spans(frame(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == repeats_of(texts)
    for r, t in zip(got, texts):
        assert sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2])) == r["n_removed"]
    assert suffix.repeated_spans(frame(spark, texts).limit(0)).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(14)
    for letters in (2, 5, 200):
        s = rng.integers(1, letters + 1, 400).astype(np.uint16)
        s[[100, 250, 399]] = 0
        order = suffix.suffix_array(s)
        raw = s.astype(">u2").tobytes()
        assert order.tolist() == sorted(range(400), key=lambda i: raw[2 * i :])
        common = suffix.common_prefixes(s, order, np.array([0, 101, 251]), np.array([100, 149, 148]), 50)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            n = 0
            while n < 50 and b + n < 400 and a + n < 400 and s[a + n] == s[b + n] != 0:
                n += 1
            assert common[b] == n or s[b] == 0


def test_long_texts_in_pieces(monkeypatch):
    raw = bytes(np.random.default_rng(15).integers(97, 110, 5000, dtype=np.uint8))
    whole = suffix.text_segments(raw)
    monkeypatch.setattr(suffix, "_PIECE", 900)
    fp, begin, count = suffix.text_segments(raw)
    spread = lambda f, b, c: {p: x for x, s, n in zip(f.tolist(), b.tolist(), c.tolist()) for p in range(s, s + n)}
    assert spread(fp, begin, count) == spread(*whole)


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in p.STAGES[:-1]:
        path = staging_path(spark, name)
        stage(spark, seen, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and 0 < after.count() <= seen.count()
        seen = after
    assert p.run(spark, SF).count() == seen.count()
    assert [k for k, _ in p.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "bpe"]


def test_payload_query_moves_no_tensors(spark):
    from talewright.llm import jpeg

    own, whole = (f(spark, "/root/testdata/sf0.001") for f in (jpeg.media_payload, jpeg.op6_media))
    assert "tensor" not in own._jdf.queryExecution().analyzed().toString() and "tensor" in whole.columns
    assert sorted(own.collect()) == sorted(whole.select(own.columns).collect())
