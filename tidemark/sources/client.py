"""A paginated JSON service: throttle, retries, pages."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

MAX_PAGES, ATTEMPTS, JITTER = 500, 5, 0.25


class Refused(PermissionError):
    """The service doesn't accept the key: trying again is of no use."""


class Unavailable(ConnectionError):
    """All attempts failed."""


def redact(text: str) -> str:
    return re.sub(r"(?i)(apikey=)[^&\s\"']+", r"\1***REDACTED***", text)


@dataclass
class Client:
    """``get(url)`` returns (status, parsed body).  One client has one budget of requests."""

    get: Callable[[str], tuple[int, dict]]
    per_minute: float = 5
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: float | None = field(default=None, repr=False)

    def _wait(self) -> None:
        if self._last is not None and (left := self._last + 60 / self.per_minute - self.clock()) > 0:
            self.sleep(left)
        self._last = self.clock()

    def request(self, url: str) -> dict:
        status = None
        for attempt in range(ATTEMPTS):
            if attempt:
                self.sleep(2 ** (attempt - 1) * (1 + JITTER * random.random()))
            self._wait()
            try:
                status, body = self.get(url)
            except OSError as e:
                status = redact(str(e))
                continue
            if status in (401, 403):
                raise Refused(redact(f"{status} from {url}"))
            if status == 429 or status >= 500:
                continue
            if status != 200:
                raise Unavailable(redact(f"{status} from {url}"))
            return body
        raise Unavailable(redact(f"{ATTEMPTS} attempts failed, last {status}: {url}"))

    def pages(self, url: str) -> Iterator[dict]:
        """Rows of all pages, each with the id of the request that brought it."""
        seen: set[str] = set()
        while url:
            if url in seen:
                raise Unavailable(redact(f"pages go round: {url}"))
            if len(seen) >= MAX_PAGES:
                raise Unavailable(f"more than {MAX_PAGES} pages")
            seen.add(url)
            body = self.request(url)
            for row in body.get("results") or []:
                yield row | {"_request_id": body.get("request_id")}
            url = body.get("next_url")
