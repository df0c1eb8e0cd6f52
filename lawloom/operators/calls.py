"""Several model calls at a time inside a task, with repeated tries."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Any

Model = Callable[[list[dict[str, str]]], Any]
Answer = tuple[Any, str | None, str | None]  # id, response, error


@dataclass(frozen=True)
class Calls:
    """How a task calls the model.

    threads: calls at a time in each task. With more than one, the model must allow
        calls from several threads.
    tries: calls for one request at most; the last failure is the request's error.
    wait, longest_wait: seconds before the second try, doubled for every later one up to
        the longest, and varied at random so that tasks do not come back all at once.
    """

    threads: int = 1
    tries: int = 1
    wait: float = 0.5
    longest_wait: float = 30.0

    def __post_init__(self) -> None:
        if self.threads < 1 or self.tries < 1 or self.wait < 0 or self.longest_wait < 0:
            raise ValueError("threads and tries are at least 1, waits at least 0")

    def pause(self, failed: int) -> float:
        """Seconds to wait after that many failed tries."""
        return min(self.longest_wait, self.wait * 2 ** (failed - 1)) * random.uniform(0.5, 1.0)

    def tasks(self, max_parallel: int) -> int:
        """Tasks that together make at most `max_parallel` calls at a time."""
        return max(1, max_parallel // self.threads)


def ask(model: Model, messages: list[dict[str, str]], calls: Calls = Calls()) -> tuple[str | None, str | None]:
    """(response, error) of one request; a failed call is a result, not a failed job."""
    failed = 0
    while True:
        try:
            answer = model(messages)
            return (answer if isinstance(answer, str) else json.dumps(answer, ensure_ascii=False)), None
        except Exception as exc:
            failed += 1
            if failed >= calls.tries:
                return None, f"{type(exc).__name__}: {exc}"
        time.sleep(calls.pause(failed))


def ask_all(model: Model, requests: Iterable[tuple[Any, list[dict[str, str]]]], calls: Calls) -> Iterator[Answer]:
    """Answers to (id, messages) requests, as they come.

    Requests are taken from the iterator only when a thread will soon be free, so that
    no more than twice as many as there are threads are held.
    """
    if calls.threads == 1:
        for key, messages in requests:
            yield key, *ask(model, messages, calls)
        return
    waiting: dict[Future, Any] = {}
    pool = ThreadPoolExecutor(calls.threads)
    try:
        for key, messages in requests:
            waiting[pool.submit(ask, model, messages, calls)] = key
            if len(waiting) >= 2 * calls.threads:
                yield from _done(waiting)
        while waiting:
            yield from _done(waiting)
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def _done(waiting: dict[Future, Any]) -> Iterator[Answer]:
    finished, _ = wait(waiting, return_when=FIRST_COMPLETED)
    for future in finished:
        yield waiting.pop(future), *future.result()
