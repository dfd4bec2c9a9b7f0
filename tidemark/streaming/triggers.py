"""Windows that fire when a trigger says so.

A ``Trigger`` is asked for every element and at every time it has set, and answers with what to do with the
window: continue, fire (emit the result so far), purge (forget the contents), or both. Elements come in event-time
order (``stateful.in_order``), so one tumbling window per key is open at a time. The end of a window, its
last microsecond, is a time that is always set; after it contents and trigger state are gone.

    class EveryThird(Trigger):
        state = "bigint"
        def begin(self): return 0
        def on_element(self, mark, us, window): return (mark + 1) % 3, FIRE_AND_PURGE if mark == 2 else CONTINUE

State per key: the window's start, its accumulator, the trigger's mark and its next time.
"""

from __future__ import annotations

from enum import Flag
from typing import Any

from pyspark.sql import Row

from tidemark.streaming.stateful import Automaton


class Action(Flag):
    CONTINUE = 0
    FIRE = 1
    PURGE = 2
    FIRE_AND_PURGE = 3


CONTINUE, FIRE, PURGE, FIRE_AND_PURGE = Action.CONTINUE, Action.FIRE, Action.PURGE, Action.FIRE_AND_PURGE
Window = tuple[int, int]  # [start, end)


class Trigger:
    """``state`` is the SQL type of the mark that the trigger keeps per window, ``begin`` the first one."""

    state: str = "bigint"

    def begin(self) -> Any:
        return 0

    def on_element(self, mark: Any, us: int, window: Window) -> tuple[Any, Action]:
        return mark, CONTINUE

    def next_time(self, mark: Any, window: Window) -> int | None:
        """The next time to be called at, besides the end."""
        return None

    def on_time(self, mark: Any, us: int, window: Window) -> tuple[Any, Action]:
        return mark, CONTINUE


class AtEnd(Trigger):
    """Fires once, when the window is complete."""

    def on_time(self, mark, us, window):
        return mark, FIRE if us == window[1] - 1 else CONTINUE


class Early(Trigger):
    """Fires at every whole tick after the first element, and when the window is complete. Keeps the contents."""

    def __init__(self, tick: int):
        self.tick = tick

    def on_element(self, mark, us, window):
        return mark or us - us % self.tick + self.tick, CONTINUE

    def next_time(self, mark, window):
        return mark if mark and mark < window[1] else None

    def on_time(self, mark, us, window):
        return (mark + self.tick if us == mark else mark), FIRE


class EveryN(Trigger):
    """Fires on every n-th element and starts from nothing; what is left at the end is not fired."""

    def __init__(self, n: int):
        self.n = n

    def on_element(self, mark, us, window):
        return (0, FIRE_AND_PURGE) if mark + 1 == self.n else (mark + 1, CONTINUE)


class Fold:
    """Contents of a window as one value of SQL type ``state``, and what a firing emits (``output`` columns)."""

    state: str
    output: str

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, r: Row) -> Any:
        raise NotImplementedError

    def result(self, acc: Any) -> tuple:
        raise NotImplementedError


class Count(Fold):
    state, output = "bigint", "cnt bigint"

    def create(self):
        return 0

    def add(self, acc, r):
        return acc + 1

    def result(self, acc):
        return (acc,)


class Triggered(Automaton):
    """Tumbling windows of ``size`` under a trigger: (window_start, fired_at, results) per firing. A window that is
    empty, or purged, does not fire."""

    def __init__(self, size: int, trigger: Trigger, fold: Fold | None = None, us: str = "us"):
        self.size, self.trigger, self.fold, self.us = size, trigger, fold or Count(), us
        self.state = f"window_start bigint, acc {self.fold.state}, mark {trigger.state}"
        self.output = f"window_start bigint, fired_at bigint, {self.fold.output}"

    def begin(self):
        return (None, None, None)

    def row(self, s, r):
        us = r[self.us]
        start, acc, mark = s
        if start is None:
            start, mark = us - us % self.size, self.trigger.begin()
        acc = self.fold.add(self.fold.create() if acc is None else acc, r)
        mark, action = self.trigger.on_element(mark, us, (start, start + self.size))
        return self._act(start, acc, mark, action, us)

    def deadline(self, s):
        start, _, mark = s
        if start is None:
            return None
        end = start + self.size
        ahead = self.trigger.next_time(mark, (start, end))
        return end - 1 if ahead is None else min(ahead, end - 1)

    def fire(self, s, t):
        start, acc, mark = s
        mark, action = self.trigger.on_time(mark, t, (start, start + self.size))
        after, out = self._act(start, acc, mark, action, t)
        return (self.begin() if t == start + self.size - 1 else after), out

    def _act(self, start, acc, mark, action, us):
        fires = Action.FIRE in action and acc is not None
        out = [(start, us, *self.fold.result(acc))] if fires else []
        return (start, None if Action.PURGE in action else acc, mark), out
