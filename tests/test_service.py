import http.client
import json
import threading

import pytest

from talewright import inference
from talewright.functions import audio
from talewright.operators import requests
from talewright.service import form_of, serve

FIXED = {"adapter": "deterministic", "text": "halo"}


@pytest.fixture(scope="module")
def server(spark):
    settings = {"model": FIXED, "service": {"max_upload_mb": 0.2, "max_audio_duration_sec": 30}}
    with serve(spark, settings) as s:
        thread = threading.Thread(target=s.serve_forever, daemon=True)
        thread.start()
        yield s
        s.shutdown()


def ask(server, method, path, body=None, kind=None):
    c = http.client.HTTPConnection("127.0.0.1", server.server_port, timeout=120)
    c.request(method, path, body, {"Content-Type": kind} if kind else {})
    r = c.getresponse()
    return r.status, json.loads(r.read())


def post(server, name, kind, content, language=None):
    parts = [b'--xyz\r\nContent-Disposition: form-data; name="file"; filename="' + name.encode() + b'"\r\nContent-Type: ' + kind.encode() + b"\r\n\r\n" + content + b"\r\n"]
    if language is not None:
        parts.append(b'--xyz\r\nContent-Disposition: form-data; name="language"\r\n\r\n' + language.encode() + b"\r\n")
    return ask(server, "POST", "/v1/transcriptions", b"".join(parts) + b"--xyz--\r\n", "multipart/form-data; boundary=xyz")


def test_status(server):
    assert ask(server, "GET", "/health") == (200, {"status": "ok"})
    assert ask(server, "GET", "/ready") == (200, {"ready": True, "model": "deterministic-stub", "reason": None})
    assert ask(server, "GET", "/v1/model")[1] == {"model_id": "deterministic-stub", "adapter": "deterministic", "device": "auto", "compute_type": "auto", "default_language": "id"}
    assert ask(server, "GET", "/x")[0] == 404 and ask(server, "POST", "/x", b"")[0] == 404


def test_transcriptions(server):
    wav = audio.encode_wav(audio.tone(1))
    millis = int(1000 * audio.inspect(wav).duration_sec)
    assert post(server, "a.wav", "audio/wav", wav) == (200, {"text": "halo", "language": "id", "durationMs": millis, "model": "deterministic-stub"})
    assert post(server, "a.WAV", "application/octet-stream", wav, "en")[1]["language"] == "en"
    assert post(server, "a.wav", "audio/wav", wav, "")[1]["language"] == "id"


@pytest.mark.parametrize("name, kind, content, status, code", [
    ("a.txt", "audio/wav", b"x", 415, "unsupported_format"), ("a", "audio/wav", b"x", 415, "unsupported_format"), ("a.wav", "text/plain", b"x", 415, "unsupported_media_type"), ("a.wav", "audio/wav", b"", 400, "empty_upload"),
    ("a.wav", "audio/wav", b"no audio", 400, "invalid_audio"), ("a.wav", "audio/wav", bytes(230_000), 413, "payload_too_large"), ("a.wav", "audio/wav", bytes(400_000), 413, "payload_too_large"),
])
def test_refusals(server, name, kind, content, status, code):
    got = post(server, name, kind, content)
    assert got[0] == status and got[1]["error"]["code"] == code


def test_no_form(server):
    assert ask(server, "POST", "/v1/transcriptions", b"{}", "application/json")[1]["error"]["code"] == "unsupported_format"
    assert form_of("text/plain", b"x") == {}


def test_a_model_that_does_not_load(spark):
    with serve(spark, {"model": {"adapter": "faster_whisper", "model_id": "tiny"}}) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        status, body = ask(s, "GET", "/ready")
        assert status == 503 and not body["ready"] and "tiny" in body["reason"]
        assert ask(s, "GET", "/health")[0] == 200
        assert post(s, "a.wav", "audio/wav", audio.encode_wav(audio.tone(1)))[0] == 500
        s.shutdown()


def test_plans():
    known = inference.plan({"adapter": "deterministic", "model_id": None})
    assert known["model_id"] == "deterministic-stub" and known["beam_size"] == 5
    with pytest.raises(ValueError, match="no adapter"):
        inference.plan({"adapter": "other"})
    assert requests.readiness({"adapter": "other"})[0] is False


@pytest.mark.parametrize("asked, there, want", [
    ({}, 0, ("cpu", "int8")), ({}, 2, ("cuda", "float16")), ({"device": "cpu"}, 2, ("cpu", "int8")), ({"device": "cuda"}, 0, ("cuda", "float16")), ({"device": "auto", "compute_type": "float32"}, 1, ("cuda", "float32")), ({"device": "mps"}, 1, ("mps", "int8")),
])
def test_placement(asked, there, want):
    assert inference.placement(asked, lambda: there) == want


def test_an_engine_of_ones_own(monkeypatch):
    """What the adapter does with a runtime: loads it once, strips segments, passes the settings on."""
    import sys
    import types

    made = []

    class Runtime:
        def __init__(self, name, device, compute_type, **more):
            made.append((name, device, compute_type, more))

        def transcribe(self, samples, language, beam_size, vad_filter):
            assert samples.dtype.name == "float32" and (beam_size, vad_filter) == (3, True)
            piece = lambda a, b, t: types.SimpleNamespace(start=a, end=b, text=t)
            return iter([piece(0, 1, " a "), piece(1, 2, " "), piece(2, 3, "b")]), types.SimpleNamespace(language=language, duration=3.5)

    monkeypatch.setitem(sys.modules, "faster_whisper", types.SimpleNamespace(WhisperModel=Runtime))
    load, hear = inference.opened(inference.plan({"model_id": "m", "device": "cpu", "beam_size": 3, "download_root": "d"}))
    load()
    wav = audio.encode_wav(audio.tone(1))
    assert hear(wav, "en") == ("a b", "en", 3500, [(0, 1, "a"), (1, 2, ""), (2, 3, "b")]) and hear(wav, "en")
    assert made == [("m", "cpu", "int8", {"download_root": "d"})]
