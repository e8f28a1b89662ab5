"""Calls of a slow user function with a deadline, tries and a pool of workers, inside one task."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass


class Expired(TimeoutError):
    """A call was not back in time."""


def within(function: Callable[[], object], seconds: float | None):
    """The result of ``function``, or ``Expired`` after so many seconds.

    A call that is late goes on in a thread of its own, which holds up neither the task nor its end; its answer is
    thrown away.
    """
    if seconds is None:
        return function()
    back: queue.SimpleQueue = queue.SimpleQueue()

    def run() -> None:
        try:
            back.put((function(), None))
        except BaseException as error:  # noqa: BLE001 - handed to the caller
            back.put((None, error))

    threading.Thread(target=run, daemon=True).start()
    try:
        value, error = back.get(timeout=seconds)
    except queue.Empty:
        raise Expired(f"no answer within {seconds:g} s") from None
    if error is not None:
        raise error
    return value


@dataclass(frozen=True)
class Limits:
    """How a function is called.

    ``timeout`` is the deadline of one call in seconds (None: no deadline), ``tries`` how often one is made;
    between tries it waits ``backoff`` seconds, twice as long each time, at most ``max_backoff``. ``batch`` prompts go
    into one call (None: all at hand), and ``workers`` calls run at a time in a task.
    """

    timeout: float | None = 240.0
    tries: int = 2
    backoff: float = 0.0
    max_backoff: float = 60.0
    batch: int | None = None
    workers: int = 1


@dataclass(frozen=True)
class Answer:
    text: str | None
    error: str | None
    started: float
    ended: float
    seconds: float  # its share of the calls it was part of


def _tried(predict, texts: Sequence[str], limits: Limits) -> tuple[list[str] | None, str | None]:
    """Answers of one call, or the last error. A call of several prompts that expires is not made again as a whole."""
    error = "no attempt"
    for i in range(max(1, limits.tries)):
        if i and limits.backoff:
            time.sleep(min(limits.max_backoff, limits.backoff * 2 ** (i - 1)))
        try:
            got = list(within(lambda: predict(texts), limits.timeout))
            if len(got) != len(texts):
                raise ValueError(f"{len(got)} answers to {len(texts)} prompts")
            return got, None
        except Exception as e:  # noqa: BLE001 - any failure of the user function is logged
            error = str(e) or type(e).__name__
            if isinstance(e, Expired) and len(texts) > 1:
                break
    return None, error


def _asked(predict, texts: Sequence[str], limits: Limits) -> list[Answer]:
    """One answer or error per prompt: prompts whose call failed together are asked one by one."""
    started, clock = time.time(), time.monotonic()
    got, error = _tried(predict, texts, limits)
    took = (time.monotonic() - clock) / len(texts)
    if got is not None or len(texts) == 1:
        return [Answer(a, error, started, time.time(), took) for a in got or [None]]
    out = []
    for text in texts:
        (one,) = _asked(predict, [text], limits)
        out.append(Answer(one.text, one.error, started, one.ended, took + one.seconds))
    return out


def ask_all(predict, texts: Sequence[str], limits: Limits) -> Iterator[Answer]:
    """The answers to all texts, in their order."""
    size = limits.batch or max(1, len(texts))
    calls = [texts[i : i + size] for i in range(0, len(texts), size)]
    if limits.workers <= 1:
        for some in calls:
            yield from _asked(predict, some, limits)
        return
    with ThreadPoolExecutor(limits.workers) as pool:
        for found in pool.map(lambda some: _asked(predict, some, limits), calls):
            yield from found
