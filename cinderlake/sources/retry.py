"""Retries of a landing job's requests: a server's hint or a minute when it limits the rate, growing waits for lost connections."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from typing import TypeVar

Result = TypeVar("Result")
RETRIES, LIMITED_WAIT, FIRST_WAIT, LONGEST_WAIT = 4, 60.0, 2.0, 30.0


class RateLimited(Exception):
    """The server asked to wait; ``payload`` is what it said."""

    def __init__(self, payload: object) -> None:
        super().__init__(str(payload))
        self.payload = payload


def hinted_wait(payload: object) -> float:
    """The seconds that the details of a rate-limit payload name, else a minute."""
    error = payload.get("error") if isinstance(payload, dict) else None
    details = error.get("details") if isinstance(error, dict) and error.get("code") == 429 else None
    for text in details if isinstance(details, list) else ():
        if found := re.search(r"Retry after (\d+) sec", str(text)):
            return float(found[1])
    return LIMITED_WAIT


def checked(payload: object) -> object:
    """A service's answer; one that says the rate is limited raises."""
    error = payload.get("error") if isinstance(payload, dict) else None
    if isinstance(error, dict) and error.get("code") == 429:
        raise RateLimited(payload)
    return payload


def with_retries(call: Callable[[], Result], retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> Result:
    """The call's result; its last error if it fails ``retries`` times more after the first, or at once for other errors."""
    for attempt in range(retries + 1):
        try:
            return call()
        except (RateLimited, ConnectionError, TimeoutError) as error:
            if attempt == retries:
                raise
            sleep(hinted_wait(error.payload) if isinstance(error, RateLimited) else min(LONGEST_WAIT, FIRST_WAIT * 2**attempt))
    raise AssertionError("unreachable")
