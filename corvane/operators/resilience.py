"""What a model's backend may do when it fails: kinds of errors, waits, splitting, and a brake on the rate of calls."""

from __future__ import annotations

import json
import math
import re
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any, TypeVar

V = TypeVar("V")

# What messages say; every part of one tuple must be there.
KINDS: dict[str, tuple[tuple[str, ...], ...]] = {
    "too_large": (
        ("http 413",), ("request too large",), ("rate_limit_exceeded", "requested", "limit"), ("tokens per minute", "requested", "limit"), ("context_length_exceeded",),
    ),
    "retryable": (
        ("http 429",), ("rate limit",), ("rate_limit_exceeded",), ("too many requests",), ("retry",), ("temporarily unavailable",), ("timeout",), ("timed out",), ("http 408",),
        ("http 500",), ("http 502",), ("http 503",), ("http 504",), ("network",), ("connection",),
    ),
    "rate_limit": (("http 429",), ('"status":429',), ("too many requests",), ("rate_limit_exceeded",), ("tokens per minute",)),
    "output": (
        ("invalid json",), ("decode",), ("empty response",), ("empty content",), ("returned no choices",), ("returned no candidates",), ("model returned",),
    ),
    "splittable": (("timeout",), ("too large",), ("invalid json",)),
    "hard_quota": (("generaterequestsperdayperprojectperformodel-freetier",), ("daily request quota",)),
}
DAILY, MINUTELY, TOKENS, REQUESTS = (
    "GenerateRequestsPerDayPerProjectPerModel-FreeTier",
    "GenerateRequestsPerMinutePerProjectPerModel-FreeTier",
    "generate_content_free_tier_input_token_count",
    "generate_content_free_tier_requests",
)
_WAIT = re.compile(r"(?:retry|try again) in\s+(\d+(?:\.\d+)?)(ms|s)?", re.IGNORECASE)
_DELAY = re.compile(r"^(\d+(?:\.\d+)?)(ms|s)$")


class MalformedOutput(ValueError):
    """A model's answer that isn't what was asked for."""


class Cancelled(RuntimeError):
    """The user stopped the work."""


def is_kind(error: Any, kind: str) -> bool:
    """Whether an error's message is of a kind."""
    text = str(error or "").strip().lower()
    return any(all(x in text for x in parts) for parts in KINDS[kind])


def splittable(error: Exception, n: int) -> bool:
    """Whether a batch of ``n`` records may do better in halves."""
    return n > 1 and (isinstance(error, MalformedOutput) or is_kind(error, "splittable"))


def daily_quota(body: str) -> bool:
    return DAILY in body


def _seconds(amount: str, unit: str | None) -> int:
    value = float(amount) / (1000 if (unit or "s").lower() == "ms" else 1)
    return math.ceil(value) if value > 0 else 0


def wait_of_message(error: Any) -> int:
    """Seconds that a message asks to wait, one at least; 0 if it asks for none."""
    m = _WAIT.search(str(error or ""))
    return max(1, _seconds(m[1], m[2])) if m else 0


def _error_of(body: str) -> tuple[Any, str]:
    """The error of a JSON body, and its message; None for what is no JSON object."""
    try:
        payload = json.loads(body)
    except ValueError:
        return None, ""
    if not isinstance(payload, dict):
        return None, ""
    error = payload.get("error", {})
    if isinstance(error, str):
        return error, error
    holder = error if isinstance(error, dict) and error else payload
    return error or payload, str(holder.get("message", ""))


def retry_delay(body: str) -> int | None:
    """Seconds until a retry: of a body's details, else of its message, else of its text; None if it doesn't say."""
    error, message = _error_of(body)
    details = error.get("details", []) if isinstance(error, dict) else []
    for detail in [details] if isinstance(details, dict) else details if isinstance(details, list) else []:
        said = detail.get("retryDelay") if isinstance(detail, dict) else None
        if isinstance(said, str) and (m := _DELAY.match(said.strip().lower())):
            return _seconds(m[1], m[2])
    for text in (message, body):
        if (m := _WAIT.search(text)) and m[2]:
            return _seconds(m[1], m[2])
    return None


def quota_message(status: int, body: str) -> str:
    """One line on a refusal: its message, the limits that it names, the wait, and which free tier is used up."""
    error, message = _error_of(body)
    if error is None:
        return f"HTTP {status}: {body}"
    out = message or f"HTTP {status}"
    limit, asked = (re.search(rf"{x}\s+([0-9]+)", out, re.IGNORECASE) for x in ("Limit", "Requested"))
    if limit and asked:
        out += f" (limit={limit[1]}, requested={asked[1]})"
    if (seconds := retry_delay(body)) is not None:
        out += f" Suggested wait: {seconds}s."
    if TOKENS in body:
        out += " You hit the free-tier input-token-per-minute limit for this model."
    for mark, words in (
        (DAILY, "the free-tier daily request quota for this model/project"),
        (MINUTELY, "the free-tier requests-per-minute limit for this model/project"),
        (REQUESTS, "a free-tier request quota for this model/project"),
    ):
        if mark in body:
            out += f" You hit {words}."
            break
    return f"HTTP {status}: {out}"


def in_halves(items: Sequence[Any], call: Callable[[Sequence[Any]], V], merge: Callable[[V, V], V], may_split=lambda e: is_kind(e, "too_large"), depth: int = 8) -> V:
    """``call`` of all items, or of their halves where it fails in a way that ``may_split`` allows, ``depth`` times at most."""
    try:
        return call(items)
    except Exception as error:
        if len(items) < 2 or depth <= 0 or not may_split(error):
            raise
    half = len(items) // 2
    return merge(*(in_halves(x, call, merge, may_split, depth - 1) for x in (items[:half], items[half:])))


USAGE = ("prompt_tokens", "completion_tokens", "total_tokens")


def added(*usages: dict[str, Any]) -> dict[str, int]:
    """Token counts summed; what is missing counts as 0."""
    return {k: sum(int(u.get(k, 0) or 0) for u in usages) for k in USAGE}


def pause(seconds: float, stopped: Callable[[], bool] = lambda: False, step: float = 0.25) -> None:
    """Sleeps in steps, and raises ``Cancelled`` as soon as it should stop."""
    until = time.monotonic() + max(0.0, seconds)
    while (left := until - time.monotonic()) > 0:
        if stopped():
            raise Cancelled("stopped by the user")
        time.sleep(min(step, left))


class Brake:
    """Slows the calls of one task down after refusals, and lets them go again after quiet.

    A refusal pauses for what it asks, or for longer with every attempt; three
    refusals halve the workers, ten leave a third. Twenty quiet seconds forgive
    one refusal and, once they are few, give a worker back.
    """

    QUIET, LONGEST = 20.0, 120.0

    def __init__(self, workers: int, clock: Callable[[], float] = time.monotonic) -> None:
        self.workers, self.cap, self.hits = max(1, workers), max(1, workers), 0
        self._clock, self._until, self._last, self._lock = clock, 0.0, 0.0, threading.Lock()

    def left(self) -> float:
        """Seconds of the pause that are left."""
        return max(0.0, self._until - self._clock())

    def refused(self, error: Any, attempt: int) -> float:
        """Notes a refusal; the seconds to wait."""
        with self._lock:
            self.hits, self._last = self.hits + 1, self._clock()
            asked = wait_of_message(error) or max(4, 2**attempt)
            wait = min(self.LONGEST, max(2, asked + min(30, self.hits // 2))) + self.hits % 5 * 0.4
            self._until = max(self._until, self._last + wait)
            if self.hits >= 3:
                self.cap = min(self.cap, max(1, self.workers // (3 if self.hits >= 10 else 2)))
            return self.left()

    def relax(self) -> None:
        with self._lock:
            if self._clock() - self._last < self.QUIET:
                return
            self.hits = max(0, self.hits - 1)
            if self.cap < self.workers and self.hits <= 1:
                self.cap += 1

    def wait(self, stopped: Callable[[], bool] = lambda: False) -> None:
        pause(self.left(), stopped)


@dataclass(frozen=True)
class Settings:
    timeout: int = 120
    retries: int = 2
    concurrency: int = 1


#: Calls at a time, at most; models that may be called in parallel, and the least settings that a model needs, are the caller's to say.
MOST_PARALLEL, LEAST_TIMEOUT = 100, 30


def guarded(asked: Settings, parallel: bool, least: Settings | None = None) -> Settings:
    """Settings within bounds: no parallel calls where they aren't allowed, and what a model's guard asks for."""
    out = Settings(max(LEAST_TIMEOUT, asked.timeout), max(0, asked.retries), min(MOST_PARALLEL, max(1, asked.concurrency)) if parallel else 1)
    if least is None:
        return out
    return replace(out, timeout=max(out.timeout, least.timeout), retries=max(out.retries, least.retries), concurrency=min(out.concurrency, least.concurrency))
