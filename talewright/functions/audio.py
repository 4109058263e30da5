"""Waveforms: native array functions, and WAV and FLAC files by the standard library and numpy."""

from __future__ import annotations

import io
import struct
import wave
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import flac

#: The canonical form, the longest file accepted, and the peak that is left alone.
RATE, CHANNELS, SUBTYPE = 16_000, 1, "PCM_16"
MAX_SECONDS = 600.0
PEAK = 0.95


class AudioError(ValueError):
    """The bytes are not audio that can be read safely."""


@dataclass(frozen=True)
class AudioInfo:
    sample_rate: int
    channels: int
    frames: int
    duration_sec: float
    format: str
    subtype: str

    @property
    def is_canonical(self) -> bool:
        return (self.sample_rate, self.channels, self.subtype) == (RATE, CHANNELS, SUBTYPE)


def is_canonical(sample_rate: Column, channels: Column, subtype: Column) -> Column:
    return (sample_rate == RATE) & (channels == CHANNELS) & (subtype == SUBTYPE)


def to_mono(frames: Column) -> Column:
    """array<double> of array<array<double>>: the mean over the channels of each frame."""
    return F.transform(frames, lambda f: F.aggregate(f, F.lit(-0.0), lambda a, x: a + x) / F.size(f))


def guard_peak(wave_: Column, peak: float = PEAK) -> Column:
    """Scale down to `peak` where the largest absolute sample is above it; empty arrays stay."""
    top = F.array_max(F.transform(wave_, lambda x: F.abs(x)))
    return F.when(top > peak, F.transform(wave_, lambda x: x * (F.lit(peak) / top))).otherwise(wave_)


def _chunks(raw: bytes) -> dict[bytes, tuple[int, int]]:
    if raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        raise AudioError("cannot read header: not a WAV file")
    found, at = {}, 12
    while at + 8 <= len(raw):
        name, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        found.setdefault(name, (at + 8, min(size, len(raw) - at - 8)))
        at += 8 + size + size % 2
    return found


def _checked(rate: int, channels: int, frames: int, form: str, subtype: str) -> AudioInfo:
    seconds = frames / rate
    if seconds <= 0:
        raise AudioError("duration is not positive")
    if seconds > MAX_SECONDS:
        raise AudioError(f"duration ({seconds:.1f}s) exceeds {MAX_SECONDS}s")
    return AudioInfo(rate, channels, frames, seconds, form, subtype)


def inspect(raw: bytes | None) -> AudioInfo:
    """Header facts of a WAV or FLAC file; no samples are decoded."""
    if raw is None:
        raise AudioError("file does not exist")
    if not raw:
        raise AudioError("file is empty (0 bytes)")
    if raw[:4] == b"fLaC":
        try:
            rate, channels, bits, frames, *_ = flac.facts(raw)
        except flac.FlacError as exc:
            raise AudioError(f"cannot read header: {exc}") from exc
        return _checked(rate, channels, frames, "FLAC", f"PCM_{bits}" if bits > 8 else "PCM_S8")
    chunks = _chunks(raw)
    if b"fmt " not in chunks or b"data" not in chunks or chunks[b"fmt "][1] < 16:
        raise AudioError("cannot read header: no format or data")
    kind, channels, rate, _, step, bits = struct.unpack_from("<HHIIHH", raw, chunks[b"fmt "][0])
    if kind == 0xFFFE and chunks[b"fmt "][1] >= 26:
        kind = struct.unpack_from("<H", raw, chunks[b"fmt "][0] + 24)[0]
    subtype = {(1, 8): "PCM_U8", (1, 16): "PCM_16", (1, 24): "PCM_24", (1, 32): "PCM_32", (3, 32): "FLOAT", (3, 64): "DOUBLE"}.get((kind, bits))
    if subtype is None or not channels or not rate or not step:
        raise AudioError("cannot read header: unsupported sample format")
    return _checked(rate, channels, chunks[b"data"][1] // step, "WAV", subtype)


def decode(raw: bytes) -> tuple[np.ndarray, int]:
    """float32 samples in [-1, 1], frames x channels (one-dimensional if mono), and the rate."""
    info = inspect(raw)
    if info.format == "FLAC":
        try:
            found = flac.samples(raw) / 2.0 ** (flac.facts(raw)[2] - 1)
        except flac.FlacError as exc:
            raise AudioError(f"cannot decode: {exc}") from exc
        return found.astype(np.float32)[:, 0] if info.channels == 1 else found.astype(np.float32), info.sample_rate
    at, size = _chunks(raw)[b"data"]
    step = {"PCM_U8": 1, "PCM_16": 2, "PCM_24": 3, "PCM_32": 4, "FLOAT": 4, "DOUBLE": 8}[info.subtype]
    data = raw[at : at + info.frames * info.channels * step]
    if info.subtype == "PCM_24":
        b = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) / 2.0**31
    elif info.subtype == "PCM_U8":
        x = (np.frombuffer(data, np.uint8).astype(np.float64) - 128) / 128
    elif info.subtype in ("FLOAT", "DOUBLE"):
        x = np.frombuffer(data, "<f4" if step == 4 else "<f8").astype(np.float64)
    else:
        x = np.frombuffer(data, f"<i{step}") / 2.0 ** (8 * step - 1)
    x = x.astype(np.float32)
    return (x if info.channels == 1 else x.reshape(-1, info.channels)), info.sample_rate


def mono(x: np.ndarray) -> np.ndarray:
    if x.ndim == 1:
        return x
    if x.ndim == 2:
        return x.mean(axis=1).astype(np.float32)
    raise AudioError(f"unexpected shape {x.shape}")


def resample(x: np.ndarray, rate: int, target: int = RATE, half: int = 32) -> np.ndarray:
    """Windowed-sinc resampling; the same array when the rates are equal. Equal to other resamplers within a tolerance only."""
    if rate == target:
        return x
    n = int(round(len(x) * target / rate))
    cut = min(1.0, target / rate)
    reach = int(np.ceil(half / cut))
    padded = np.concatenate([np.zeros(reach, x.dtype), x, np.zeros(reach + 1, x.dtype)])
    out = np.empty(n, np.float32)
    offsets = np.arange(-reach + 1, reach + 1)
    for at in range(0, n, 8192):
        where = np.arange(at, min(at + 8192, n)) * (rate / target)
        base = np.floor(where).astype(np.int64)
        t = offsets[None, :] - (where - base)[:, None]
        window = np.where(np.abs(t) < reach, 0.5 + 0.5 * np.cos(np.pi * t / reach), 0.0)
        out[at : at + len(where)] = (padded[base[:, None] + offsets + reach] * np.sinc(cut * t) * cut * window).sum(axis=1)
    return out


def peak_guard(x: np.ndarray, peak: float = PEAK) -> np.ndarray:
    top = float(np.abs(x).max()) if x.size else 0.0
    return (x * (peak / top)).astype(np.float32) if top > peak else x


def canonical(raw: bytes) -> np.ndarray:
    """Mono samples at the canonical rate, peak guarded."""
    x, rate = decode(raw)
    return peak_guard(resample(mono(x), rate))


def encode_wav(x: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit PCM; one-dimensional samples are mono."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1 if x.ndim == 1 else x.shape[1])
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.clip(np.round(np.asarray(x, np.float64) * 32768), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def tone(seed: int, rate: int = RATE) -> np.ndarray:
    """A clip for smoke runs: a tone and noise, one to three seconds, fixed by its seed."""
    random = np.random.default_rng(seed)
    t = np.arange(int(random.uniform(1.0, 3.0) * rate)) / rate
    return (0.3 * np.sin(2 * np.pi * random.uniform(200, 800) * t) + 0.01 * random.standard_normal(len(t))).astype(np.float32)
