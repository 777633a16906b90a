"""Calls to an interface, spaced and repeated, for readers that fetch over a network."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")

#: Answers that ask for a pause.
BUSY = frozenset({403, 429})


class Busy(Exception):
    """An interface asks to wait; ``status`` is its answer, ``after`` the seconds it names, if any."""

    def __init__(self, status: int, after: float | None = None) -> None:
        super().__init__(f"status {status}")
        self.status, self.after = status, after


class Throttle:
    """At least ``delay`` seconds between calls; busy answers are repeated after a pause that doubles.

    One per reader, so the pace holds for a partition. ``clock`` and ``sleep`` are for tests.
    """

    def __init__(self, delay: float = 1.0, retries: int = 3, pause: float = 30.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.delay, self.retries, self.pause, self.clock, self.sleep = delay, retries, pause, clock, sleep
        self.last: float | None = None

    def call(self, fetch: Callable[..., T], *given) -> T:
        """What ``fetch`` returns; the last :class:`Busy` is raised where all tries meet one."""
        for attempt in range(self.retries + 1):
            if self.last is not None and (rest := self.delay - (self.clock() - self.last)) > 0:
                self.sleep(rest)
            self.last = self.clock()
            try:
                return fetch(*given)
            except Busy as busy:
                if busy.status not in BUSY or attempt == self.retries:
                    raise
                self.sleep(busy.after if busy.after is not None else self.pause * 2**attempt)
        raise AssertionError("unreachable")
