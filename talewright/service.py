"""A small HTTP service over the batch functions, by the standard library.

GET /health, /ready and /v1/model, POST /v1/transcriptions (multipart: file, language). Every request is a row; what
Spark answers is the response. For throughput, use the batch function or the file stream instead.
"""

from __future__ import annotations

import email.parser
import email.policy
import json
import logging
from collections.abc import Mapping
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession

from .functions.text import drop_private
from .operators import requests

log = logging.getLogger("talewright.service")
_REQUEST = "filename string, content_type string, language string, content binary"


def form_of(content_type: str, body: bytes) -> dict[str, tuple[str, str, bytes]]:
    """Fields of a multipart form: (file name, content type, content) by name; {} of anything else."""
    message = email.parser.BytesParser(policy=email.policy.HTTP).parsebytes(b"Content-Type: " + content_type.encode("latin-1") + b"\r\n\r\n" + body)
    if not message.is_multipart():
        return {}
    return {p.get_param("name", header="content-disposition"): (p.get_filename() or "", p.get_content_type(), p.get_payload(decode=True) or b"") for p in message.iter_parts()}


def serve(spark: SparkSession, settings: Mapping, port: int = 0) -> ThreadingHTTPServer:
    """A server that is bound and ready to run (serve_forever); port 0 takes a free one. The model is tried once now, and again
    at each /ready until it loads."""
    model = dict(settings.get("model") or {})
    state = {"ready": requests.readiness(model)}

    class Handler(BaseHTTPRequestHandler):
        def reply(self, status: int, body: str | dict) -> None:
            raw = (body if isinstance(body, str) else json.dumps(body)).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def do_GET(self) -> None:
            if self.path == "/health":
                self.reply(200, {"status": "ok"})
            elif self.path == "/ready":
                if not state["ready"][0]:
                    state["ready"] = requests.readiness(model)
                ok, name, reason = state["ready"]
                self.reply(200 if ok else 503, {"ready": ok, "model": name, "reason": reason})
            elif self.path == "/v1/model":
                self.reply(200, requests.model_info(spark, model).first().asDict())
            else:
                self.reply(404, {"error": {"code": "not_found", "message": self.path}})

        def do_POST(self) -> None:
            if self.path != "/v1/transcriptions":
                return self.reply(404, {"error": {"code": "not_found", "message": self.path}})
            most = requests.limits(dict(settings))["max_bytes"] + (1 << 16)  # the form's own lines
            size = int(self.headers.get("Content-Length") or 0)
            if size > most:  # nothing of it is read
                self.close_connection = True
                return self.reply(413, {"error": {"code": "payload_too_large", "message": "payload_too_large"}})
            form = form_of(self.headers.get("Content-Type", ""), self.rfile.read(size))
            name, kind, content = form.get("file", ("", "", b""))
            language = form.get("language", ("", "", b"id"))[2].decode("utf-8", "replace")
            row = {"filename": name, "content_type": kind, "language": language, "content": bytearray(content)}
            log.info("request %s", {k: row[k] for k in drop_private(list(row))})
            try:
                found = requests.answer(spark.createDataFrame([tuple(row.values())], _REQUEST), model, dict(settings)).first()
            except Exception as exc:  # a fault of the cluster is no fault of the request
                return self.reply(500, {"error": {"code": "internal", "message": type(exc).__name__}})
            return self.reply(found["status"], found["body"])

        def log_message(self, form: str, *args) -> None:
            log.debug(form, *args)

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
