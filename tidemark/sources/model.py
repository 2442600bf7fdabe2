"""Calls of a chat model behind an injected transport: routing, retries, telemetry.

``post(endpoint, payload)`` returns (status, parsed body) or raises OSError; how it reaches the service
and signs the request is its own affair, so that no credential passes through here.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from tidemark.sources.client import Refused, Unavailable, redact

#: Attempts, and answers that are worth another one.
ATTEMPTS, AGAIN = 3, frozenset({429, 500, 502, 503, 504})


@dataclass(frozen=True)
class Call:
    """A tool that the model asks for."""

    id: str
    name: str
    arguments: str

    def parsed(self) -> dict:
        given = json.loads(self.arguments) if self.arguments.strip() else {}
        if not isinstance(given, dict):
            raise ValueError(f"arguments of {self.name} aren't an object")
        return given


@dataclass(frozen=True)
class Reply:
    message: dict
    model: str
    finish_reason: str | None
    in_tokens: int | None
    out_tokens: int | None
    latency_ms: float

    @property
    def content(self) -> str:
        """Text of the message; the text parts of one that comes in parts."""
        said = self.message.get("content") or ""
        return said if isinstance(said, str) else "".join(p.get("text", "") for p in said if p.get("type") == "text")

    @property
    def calls(self) -> list[Call]:
        asked = self.message.get("tool_calls") or []
        return [Call(c.get("id", ""), c["function"]["name"], c["function"].get("arguments") or "") for c in asked]


@dataclass
class Model:
    """``endpoints``: task -> endpoint.  ``record`` (a Telemetry's) gets a row for each call, failed ones too; what
    it raises doesn't reach the caller."""

    endpoints: Mapping[str, str]
    post: Callable[[str, dict], tuple[int, dict]]
    record: Callable[..., None] | None = None
    now: Callable[[], object] | None = None
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    failures: list[str] = field(default_factory=list)

    def call(self, task: str, messages: Sequence[Mapping], tools: Sequence[Mapping] | None = None, response_format: Mapping | None = None) -> Reply:
        if task not in self.endpoints:
            raise KeyError(f"no endpoint for {task}")
        if not messages or any("role" not in m for m in messages):
            raise ValueError("messages must be there and have roles")
        payload = {"messages": [dict(m) for m in messages]}
        payload |= {"tools": [dict(t) for t in tools]} if tools else {}
        payload |= {"response_format": dict(response_format)} if response_format else {}
        began = self.clock()
        try:
            body = self._sent(self.endpoints[task], payload)
            message = body["choices"][0]["message"]
        except Exception as e:
            self._note(task, self.endpoints[task], began, False, {})
            if isinstance(e, KeyError | IndexError | TypeError):
                raise Unavailable(f"{self.endpoints[task]}: the answer holds no message") from e
            raise
        model = body.get("model") or self.endpoints[task]
        used = body.get("usage") or {}
        self._note(task, model, began, True, used)
        return Reply(message, model, body["choices"][0].get("finish_reason"), used.get("prompt_tokens"), used.get("completion_tokens"), (self.clock() - began) * 1000)

    def chat(self, task: str) -> Callable[[list[dict], list[dict]], dict]:
        """The model as the tool loop wants it: messages and specs in, a message with flat tool calls out."""
        def ask(messages: list[dict], specs: list[dict]) -> dict:
            reply = self.call(task, messages, specs)
            return reply.message | {"content": reply.content, "tool_calls": [{"id": c.id, "name": c.name, "arguments": c.arguments} for c in reply.calls]}

        return ask

    def _sent(self, endpoint: str, payload: dict) -> dict:
        said = None
        for attempt in range(ATTEMPTS):
            if attempt:
                self.sleep(2.0 ** (attempt - 1))
            try:
                status, body = self.post(endpoint, payload)
            except OSError as e:
                said = redact(str(e))
                continue
            if status == 200:
                return body
            if status in (401, 403):
                raise Refused(f"{status} from {endpoint}")
            if status not in AGAIN:
                raise Unavailable(f"{status} from {endpoint}")
            said = status
        raise Unavailable(f"{ATTEMPTS} attempts failed, last {said}: {endpoint}")

    def _note(self, task: str, model: str, began: float, ok: bool, used: Mapping) -> None:
        if self.record is None:
            return
        try:
            self.record(ts=self.now() if self.now else None, task=task, model=model, latency_ms=(self.clock() - began) * 1000, ok=ok, in_tokens=used.get("prompt_tokens"), out_tokens=used.get("completion_tokens"))
        except Exception as e:
            self.failures.append(redact(str(e)))
