import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talewright.functions import align, audio, text
from talewright.sources import readers


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, ["string"] * len(values)))).select(column).first()[0]


@pytest.mark.parametrize("raw, normal", [
    ("Rp250.000.000", "rp250 000 000"), (" a\t\nb  c ", "a b c"), ("Re-port", "report"), ("é", "é"), ("ﬁn", "fin"), (None, ""), ("", ""), ("a_b!", "a_b"), ("½", "1 2"),
])
def test_normalize(spark, raw, normal):
    assert spark.createDataFrame([(raw,)], "t string").select(text.normalize(F.col("t"))).first()[0] == normal


@pytest.mark.parametrize("path, ext", [("a/b.WAV", ".wav"), (".hidden", ""), ("a.b/c", ""), ("x", ""), ("a.tar.gz", ".gz")])
def test_extension(spark, path, ext):
    assert one(spark, text.extension(F.col("p")), p=path) == ext


def test_target_path(spark):
    assert one(spark, text.canonical_target(F.col("p"), "/in/", "/out"), p="/in/x/y.flac") == "/out/x/y.wav"


def cost_of(ref, hyp):
    """Plain distance."""
    row = list(range(len(hyp) + 1))
    for i, r in enumerate(ref, 1):
        row, last = [i], row
        for j, h in enumerate(hyp, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (r != h)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
def test_alignment_is_cheapest(ref, hyp):
    s, d, i, pairs = align.align_tokens(ref, hyp)
    assert s + d + i == cost_of(ref, hyp) and len(ref) - d == len(hyp) - i and len(pairs) == s


@pytest.mark.parametrize("ref, hyp, counts, pairs", [
    ("a b", "b c", (0, 1, 1), []), ("a b", "c", (1, 1, 0), [("a", "c")]), ("a b c", "a b d", (1, 0, 0), [("c", "d")]), ("a b c", "a b b c", (0, 0, 1), []), ("", "a", (0, 0, 1), []), ("a", "", (0, 1, 0), []), ("", "", (0, 0, 0), []),
])
def test_alignment_ties(ref, hyp, counts, pairs):
    assert align.align_tokens(ref.split(), hyp.split()) == (*counts, pairs)


def test_native_distance_equals_alignment(spark):
    rng = random.Random(1)
    rows = [([rng.choice(["a", "bé", "c", "dd"]) for _ in range(rng.randint(0, 9))], [rng.choice(["a", "bé", "c", "x"]) for _ in range(rng.randint(0, 9))]) for _ in range(200)]
    rows.append(([f"w{i}" for i in range(3000)], [f"w{i}" for i in range(1, 3000)]))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, r array<string>, h array<string>")
    got = {x["i"]: x["word_errors"] for x in align.with_errors(df, "r", "h").collect()}
    for i, (r, h) in itertools.islice(enumerate(rows), 200):
        assert got[i] == cost_of(r, h)
    assert got[200] == 1


def test_audio_round_trip():
    x = audio.tone(3)
    raw = audio.encode_wav(x)
    info = audio.inspect(raw)
    assert info.is_canonical and info.frames == len(x)
    y, rate = audio.decode(raw)
    assert rate == 16000 and np.abs(x - y).max() < 1e-4


def test_canonical_audio():
    t = np.arange(44100) / 44100
    stereo = np.stack([1.5 * np.sin(2 * np.pi * 440 * t)] * 2, axis=1)
    x = audio.canonical(audio.encode_wav(np.clip(stereo, -1, 1), 44100))
    assert len(x) == 16000 and abs(np.abs(x).max() - 0.95) < 0.02
    spectrum = np.abs(np.fft.rfft(x))
    assert spectrum.argmax() == 440


@pytest.mark.parametrize("raw", [None, b"", b"RIFF", b"no audio at all", audio.encode_wav(np.zeros(0))])
def test_bad_audio(raw):
    with pytest.raises(audio.AudioError):
        audio.inspect(raw)


def test_array_audio(spark):
    row = spark.sql("SELECT array(array(1D, -1D), array(.5D, .5D)) AS f, array(0D, -1.9D) AS w, CAST(array() AS array<double>) AS e")
    got = row.select(audio.to_mono(F.col("f")), audio.guard_peak(F.col("w")), audio.guard_peak(F.col("e"))).first()
    assert got[0] == [0.0, 0.5] and got[1] == [0.0, -0.95] and got[2] == []


def test_deep_merge():
    a = {"x": {"y": 1, "z": 2}, "k": 1}
    assert readers.deep_merge(a, {"x": {"y": 5}, "n": None}) == {"x": {"y": 5, "z": 2}, "k": 1, "n": None}
    assert a["x"]["y"] == 1


class Flac:
    """A small writer of FLAC streams, one kind of subframe for each channel and frame."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits.append(format(value & (1 << n) - 1, f"0{n}b") if n else "")

    def rice(self, values, k):
        self.put(0, 2)
        self.put(0, 4)
        self.put(k, 4)
        for v in values:
            u = 2 * v if v >= 0 else -2 * v - 1
            self.bits.append("0" * (u >> k) + "1")
            self.put(u, k)

    def subframe(self, x, bits, kind):
        x = [int(v) for v in x]
        self.put(0, 1)
        if kind == "constant":
            self.put(0, 7)
            self.put(x[0], bits)
        elif kind == "verbatim":
            self.put(1, 6)
            self.put(0, 1)
            for v in x:
                self.put(v, bits)
        elif kind == "wasted":
            self.put(1, 6)
            self.bits.append("1001")  # three bits of each sample are zero
            for v in x:
                self.put(v >> 3, bits - 3)
        elif kind == "lpc":
            self.put(33, 6)
            self.put(0, 1)
            for v in x[:2]:
                self.put(v, bits)
            self.put(9, 4)
            self.put(3, 5)
            self.put(14, 10)
            self.put(-6, 10)
            self.rice([x[i] - (14 * x[i - 1] - 6 * x[i - 2] >> 3) for i in range(2, len(x))], 5)
        else:
            self.put(8 + kind, 6)
            self.put(0, 1)
            for v in x[:kind]:
                self.put(v, bits)
            self.rice(np.diff(np.array(x), kind).tolist(), 4)

    def frame(self, number, columns, how, kinds, bits, wide):
        self.put(0x3FFE, 14)
        self.put(0, 2)
        self.put(7, 4)
        self.put(0, 4)
        self.put(how, 4)
        self.put(0, 3)
        self.put(0, 1)
        for b in chr(number).encode():
            self.put(b, 8)
        self.put(len(columns[0]) - 1, 16)
        self.put(0, 8)
        for x, kind, more in zip(columns, kinds, wide):
            self.subframe(x, bits + more, kind)
        self.put(0, -sum(map(len, self.bits)) % 8)
        self.put(0, 16)

    def stream(self, x, rate, bits):
        packed = rate << 44 | x.shape[1] - 1 << 41 | bits - 1 << 36 | len(x)
        plain = b"".join(int(v).to_bytes(bits // 8, "little", signed=True) for v in x.ravel())
        info = bytes(10) + packed.to_bytes(8, "big") + hashlib.md5(plain).digest()
        text = "".join(self.bits)
        return b"fLaC" + b"\x80" + len(info).to_bytes(3, "big") + info + bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))


@pytest.mark.parametrize("bits", [16, 24])
def test_flac(bits):
    rng = np.random.default_rng(bits)
    x = np.cumsum(rng.integers(-40, 41, (1200, 2)), axis=0)
    x[200:400] = 77
    x[400:600, 0] = x[400:600, 0] // 8 * 8
    w, at = Flac(), 0
    for number, (how, kinds) in enumerate([(1, (1, 2)), (1, ("constant", "constant")), (1, ("wasted", 0)), (8, (3, 4)), (9, ("lpc", "verbatim")), (10, (2, "lpc"))] * 1):
        a, b = x[at : at + 200, 0], x[at : at + 200, 1]
        columns = {1: (a, b), 8: (a, a - b), 9: (a - b, b), 10: (a + b >> 1, a - b)}[how]
        w.frame(130 * number, columns, how, kinds, bits, {1: (0, 0), 8: (0, 1), 9: (1, 0), 10: (0, 1)}[how])
        at += 200
    raw = w.stream(x, 8000, bits)
    info = audio.inspect(raw)
    assert (info.format, info.subtype, info.frames, info.channels, info.sample_rate) == ("FLAC", f"PCM_{bits}", 1200, 2, 8000)
    y, rate = audio.decode(raw)
    assert rate == 8000 and np.array_equal(np.round(y * 2.0 ** (bits - 1)).astype(int), x)
    assert len(audio.canonical(raw)) == 2400
    for broken in (raw[:-40], raw[:200] + bytes([raw[200] ^ 1]) + raw[201:], raw[:30]):
        with pytest.raises(audio.AudioError):
            audio.decode(broken)


def test_rows_with_a_null_side_stay(spark):
    df = spark.createDataFrame([(1, ["a"], None), (2, None, None), (3, ["a"], ["b"]), (4, [f"w{i}" for i in range(3000)], [])], "i int, r array<string>, h array<string>")
    assert {x["i"]: x["word_errors"] for x in align.with_errors(df, "r", "h").collect()} == {1: None, 2: None, 3: 1, 4: 3000}


def test_long_alignment_in_bounded_memory():
    """Twenty thousand tokens on either side; the table takes a quarter of a byte for each cell."""
    import resource

    rng = random.Random(7)
    ref = [f"w{rng.randrange(500)}" for _ in range(20_000)]
    hyp = [t if rng.random() > 0.05 else "x" for t in ref if rng.random() > 0.05]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    s, d, i, pairs = align.align_tokens(ref, hyp)
    assert len(ref) - d == len(hyp) - i and len(pairs) == s and s + d + i < 2500
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20


def test_distinct_tokens_are_gathered_once(spark):
    """Not once more for each token, as inside a lambda."""
    df = spark.createDataFrame([(["a", "b", "b"], ["b", "c"]), ([], []), (None, ["a"])], "r array<string>, h array<string>")
    found = df.select(align.word_errors(df.r, df.h).alias("n"))
    assert [x["n"] for x in found.collect()] == [2, 0, None]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 1
