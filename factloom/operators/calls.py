"""Calls to services from within a task: several at a time with their order kept, and tried again after a while."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

A = TypeVar("A")
B = TypeVar("B")

#: What a service may answer now and not later.
AGAIN = (429, 500, 502, 503, 504)


class ServiceError(Exception):
    """A call that a service has turned down, with its code."""

    def __init__(self, code: int, message: str = ""):
        super().__init__(f"{code}: {message}")
        self.code = code


def passing(e: Exception) -> bool:
    """Whether a call that ended so may be right later: a code that says so, or the way to the service."""
    return e.code in AGAIN if isinstance(e, ServiceError) else isinstance(e, OSError)


def with_patience(call: Callable[[], A], attempts: int, first_wait: float, sleep: Callable[[float], None] = time.sleep) -> A:
    """The call's answer; failures that may pass are tried again, each wait twice as long as the one before."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if attempt == attempts or not passing(e):
                raise
            sleep(first_wait * 2 ** (attempt - 1))
    raise ValueError("no attempt")


def in_order(items: Iterable[A], call: Callable[[A], B], threads: int) -> Iterator[tuple[A, B]]:
    """(item, answer) in the order of the items, with at most `threads` calls under way and as many answers waiting."""
    with ThreadPoolExecutor(max(1, threads)) as pool:
        waiting: deque = deque()
        for item in items:
            waiting.append((item, pool.submit(call, item)))
            if len(waiting) >= 2 * threads:
                head, answer = waiting.popleft()
                yield head, answer.result()
        while waiting:
            head, answer = waiting.popleft()
            yield head, answer.result()
