"""The export API as plain functions, and a small HTTP server over them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

from kinfold.sources.exports import file_sha256


class NotFound(Exception):
    """404: a file is missing."""


class BadManifest(Exception):
    """500: a manifest lacks its file."""


def iso_to_ms(text: object) -> int | None:
    """Epoch milliseconds of an ISO time; one without a zone is UTC; None if it is none."""
    try:
        at = datetime.fromisoformat(str(text).replace("Z", "+00:00"))
    except ValueError:
        return None
    return int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp() * 1000)


def stream(path: Path, chunk: int = 1 << 20) -> Iterator[bytes]:
    with path.open("rb") as f:
        while block := f.read(chunk):
            yield block


class ExportService:
    def __init__(self, out: str | Path, provider: str):
        self.out, self.provider = Path(out), provider

    def health(self) -> dict:
        return {"ok": True, "provider": self.provider}

    def _meta(self, name: str) -> tuple[dict, Path]:
        path = self.out / name
        if not path.is_file():
            raise NotFound(name)
        meta = json.loads(path.read_text(encoding="utf-8"))
        if not meta.get("file"):
            raise BadManifest(name)
        target = self.out / meta["file"]
        if not target.exists():
            raise NotFound(meta["file"])
        return meta, target

    def _manifest(self, name: str, more: tuple[str, ...] = ()) -> dict:
        meta, path = self._meta(name)
        at = iso_to_ms(meta.get("exported_at_iso"))
        body = {
            "provider": self.provider,
            "file": path.name,
            "timestamp": int(path.stat().st_mtime * 1000) if at is None else at,
            "sha256": meta.get("sha256") or file_sha256(path),
            "records": meta.get("records"),
            "datasets": meta.get("datasets", []),
        }
        return body | {k: meta.get(k) for k in more}

    def full_manifest(self) -> dict:
        return self._manifest(f"{self.provider}_meta.json")

    def delta_manifest(self) -> dict:
        return self._manifest(f"{self.provider}_delta_meta.json", ("new_records", "updated_records", "full_file", "state_file"))

    def full_file(self) -> Path:
        return self._meta(f"{self.provider}_meta.json")[1]

    def delta_file(self) -> Path:
        return self._meta(f"{self.provider}_delta_meta.json")[1]


def server(service: ExportService, host: str = "0.0.0.0", port: int = 8000, prefix: str = "") -> ThreadingHTTPServer:
    """An HTTP server of the service, its routes below ``prefix``; call ``serve_forever`` on it."""
    pages = {"/": service.health, f"{prefix}/meta": service.full_manifest, f"{prefix}/delta/meta": service.delta_manifest}
    files = {f"{prefix}/file": service.full_file, f"{prefix}/delta/file": service.delta_file}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            route = self.path.split("?")[0]
            try:
                if route in pages:
                    body = json.dumps(pages[route]()).encode()
                    self._head(200, "application/json", len(body))
                    self.wfile.write(body)
                elif route in files:
                    path = files[route]()
                    self._head(200, "application/gzip", path.stat().st_size)
                    for block in stream(path):
                        self.wfile.write(block)
                else:
                    raise NotFound(route)
            except (NotFound, BadManifest) as e:
                body = json.dumps({"detail": str(e)}).encode()
                self._head(404 if isinstance(e, NotFound) else 500, "application/json", len(body))
                self.wfile.write(body)

        def _head(self, code: int, kind: str, size: int) -> None:
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(size))
            self.end_headers()

        def log_message(self, *_):
            pass

    return ThreadingHTTPServer((host, port), Handler)
