"""Retry with growing delays, for sinks that fail now and then."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")

# Seconds before the first retry, longest delay, growth per retry.
FIRST_DELAY = 5.0
MAX_DELAY = 60.0
FACTOR = 2.0


def with_backoff(
    action: Callable[[], T],
    tries: int | None = 8,
    first: float = FIRST_DELAY,
    longest: float = MAX_DELAY,
    factor: float = FACTOR,
    sleep: Callable[[float], None] = time.sleep,
) -> T:
    """Run ``action`` until it succeeds.

    Ordinary exceptions are retried; interrupts are not.  After ``tries`` attempts the
    last error is raised, so that a streaming query fails and restarts from its
    checkpoint.  ``tries=None`` never gives up.
    """
    if factor < 1.0:
        raise ValueError("factor must be at least 1")
    delay, attempt = first, 1
    while True:
        try:
            return action()
        except Exception:
            if tries is not None and attempt >= tries:
                raise
        sleep(delay)
        delay = min(delay * factor, longest)
        attempt += 1


def retrying(write: Callable, **options) -> Callable:
    """A ``foreachBatch`` function that retries ``write(batch, batch_id)``.

    ``write`` must replace what an earlier try for the same id left behind.
    """

    def run(batch, batch_id: int) -> None:
        with_backoff(lambda: write(batch, batch_id), **options)

    return run
