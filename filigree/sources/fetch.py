"""Landing of remote files: one polite, retrying reader, since the rate limit is global.

get(url, headers) is given by the caller and returns (status, body); pause
sleeps.  Nothing here needs Spark: what it lands, the readers in landing read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from pathlib import Path

Get = Callable[[str, dict[str, str]], tuple[int, bytes]]
HEAD_BYTES, MORE_BYTES = 12_000, 96_000


class Blocked(RuntimeError):
    """The server refuses all requests for a while; the run must end."""


class Missing(LookupError):
    """The file isn't there."""


class PoliteReader:
    def __init__(self, get: Get, delay: float = 0.11, tries: int = 4, pause: Callable[[float], None] = time.sleep) -> None:
        self.get, self.delay, self.tries, self.pause = get, delay, tries, pause

    def read(self, url: str, headers: dict[str, str] | None = None, absent: tuple[int, ...] = (404,)) -> bytes:
        """The body; waits longer after each 429, shortly after a server's or transport's error, and raises Blocked when 429 or 403 stays, Missing at once for a status of absent."""
        status = 0
        for n in range(self.tries):
            self.pause(self.delay)
            try:
                status, body = self.get(url, headers or {})
            except (OSError, TimeoutError):
                self.pause(min(30.0, 2.0**n))
                status = 0
                continue
            if status in (200, 206):
                return body
            if status in absent:
                raise Missing(url)
            self.pause(min(10 * self.delay * 2**n, 60.0) if status in (403, 429) else 2 * self.delay)
        if status in (403, 429):
            raise Blocked(url)
        raise ConnectionError(f"{url}: status {status}")

    def read_head(self, url: str, end: bytes = b"</SEC-HEADER>") -> bytes:
        """The file's first bytes, more of them if they don't hold the end of its header."""
        chunk = b""
        for size in (HEAD_BYTES, MORE_BYTES):
            chunk = self.read(url, {"Range": f"bytes=0-{size - 1}"})[:size]
            if end in chunk:
                break
        return chunk

    def listings(self, urls: Iterable[tuple[str, str]]) -> dict[str, bytes]:
        """Bodies by quarter of quarter listings; a quarter that isn't published yet answers 403 or 404 and is left out."""
        out = {}
        for quarter, url in urls:
            try:
                out[quarter] = self.read(url, absent=(403, 404))
            except Missing:
                continue
        return out

    def land(self, urls: Iterable[tuple[str, str]], folder: str) -> dict[str, str]:
        """Writes (name, url) files that the folder lacks; returns the error of each that failed.  Blocked ends the run."""
        failed = {}
        Path(folder).mkdir(parents=True, exist_ok=True)
        for name, url in urls:
            target = Path(folder, name)
            if target.exists():
                continue
            try:
                body = self.read(url)
            except (LookupError, ConnectionError) as problem:
                failed[name] = str(problem)
                continue
            part = target.with_suffix(target.suffix + ".part")
            part.write_bytes(body)
            part.rename(target)
        return failed
