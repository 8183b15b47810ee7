"""Fetching files with a record beside each, on the driver: what is there already isn't fetched again.

A record is JSON: url, status, fetchedAt, headers, bytes, sha256. Bytes are
saved as they come, to a part file that is then renamed.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Collection
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RECORD = "url string, status int, fetchedAt string, headers map<string,string>, bytes long, sha256 string"
#: Retries, statuses that are worth one, seconds before a blocked fetch goes on, and how often.
RETRIES, BLOCK_WAIT, BLOCK_TRIES = 5, 15 * 60, 8
Response = tuple[int, dict[str, str], bytes]


class Blocked(Exception):
    """The service refuses; nothing was recorded."""


def open_url(url: str) -> Response:
    try:
        with urllib.request.urlopen(url) as r:  # noqa: S310
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


class Fetcher:
    """opener, sleep and clock can be replaced; interval: seconds between requests."""

    def __init__(self, interval: float = 1.0, opener: Callable[[str], Response] = open_url, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> None:
        self.interval, self.opener, self.sleep, self.clock, self.last = interval, opener, sleep, clock, None

    def throttle(self) -> None:
        if self.last is not None and (wait := self.last + self.interval - self.clock()) > 0:
            self.sleep(wait)
        self.last = self.clock()

    def get(self, url: str) -> Response:
        """With retries after 429, 5xx and network errors: Retry-After, or 2, 4, 8 ... seconds."""
        for n in range(1, RETRIES + 2):
            self.throttle()
            try:
                status, headers, body = self.opener(url)
                if status != 429 and status < 500 or n > RETRIES:
                    return status, headers, body
                wait = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
            except OSError:
                if n > RETRIES:
                    raise
                wait = ""
            self.sleep(float(wait) if wait.isdigit() else 2.0**n)
        raise AssertionError

    def download(self, url: str, dest: Path, force: bool = False, missing: Collection[int] = (404,)) -> str:
        """downloaded, skipped or missing. A 403 that doesn't count as missing raises Blocked and leaves no record."""
        before = None if force else read_record(dest)
        if before and before["status"] == 200 and dest.exists():
            return "skipped"
        if before and before["status"] in missing:
            return "missing"
        status, headers, body = self.get(url)
        if status == 403 and status not in missing:
            raise Blocked(url)
        if status != 200 and status not in missing:
            raise OSError(f"{url}: status {status}")
        record = {"url": url, "status": status, "fetchedAt": datetime.now(timezone.utc).isoformat(), "headers": headers}
        if status == 200:
            record |= {"bytes": len(body), "sha256": hashlib.sha256(body).hexdigest()}
            write_atomic(dest, body)
        write_atomic(record_path(dest), json.dumps(record).encode())
        return "downloaded" if status == 200 else "missing"

    def download_patiently(self, url: str, dest: Path, force: bool = False, missing: Collection[int] = (404,)) -> str:
        """Waits and goes on when blocked, a few times."""
        for n in range(BLOCK_TRIES + 1):
            try:
                return self.download(url, dest, force, missing)
            except Blocked:
                if n == BLOCK_TRIES:
                    raise
                self.sleep(BLOCK_WAIT)
        raise AssertionError


def record_path(dest: Path) -> Path:
    return dest.with_name(dest.name + ".json")


def read_record(dest: Path) -> dict | None:
    p = record_path(dest)
    return json.loads(p.read_text()) if p.exists() else None


def write_atomic(dest: Path, body: bytes) -> None:
    dest.parent.mkdir(parents=True, exist_ok=True)
    part = dest.with_name(dest.name + ".part")
    part.write_bytes(body)
    part.rename(dest)


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """All records under a path."""
    from lexweave.sources.files import json_lines

    return json_lines(spark, path, RECORD)
