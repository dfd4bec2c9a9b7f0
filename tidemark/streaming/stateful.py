"""Custom stateful operators on transformWithState.

``InOrder`` holds the rows of a key until the watermark has passed them and then hands them to an
automaton in event-time order, together with the deadlines the automaton asked for. So the answer
does not depend on how rows were split into micro-batches and equals the batch form. Clock rule:
before a row at time t, every deadline earlier than t has fired; a deadline at exactly t has not.

Keys go in ``GROUPS`` groups by their hash. A group is visited once per micro-batch for its rows, or by its one timer if it
has none; where the watermark has passed the end of a time slot with a row or a deadline, all slots that are over are worked
off in that visit, in order of time. A few waiting rows are one value of state; more are sorted page by page into runs,
cut into blocks, and merged block by block. What Python holds at once is one page of input, or one block of every run
and the automata of one group, not the rows of a key.

Rows come to a group packed, a few hundred in a binary value of Arrow, wait pickled in blocks, as automata do, and results
leave packed: the conversion of single rows between Spark and Python, column by column, costs far more than the automata.
A row is late, and dropped, if its time is not after the watermark that its group saw in the last micro-batch that
visited it: that of the micro-batch before, or an earlier one, up to which the group has worked off all the same.

An automaton is a few lines: its state as a tuple, what a row does, what a deadline does.
Times are microseconds; Spark's timers and watermarks are milliseconds.
"""

from __future__ import annotations

import heapq
import pickle
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.clock import SECOND

Out = list[tuple]


def _columns(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names)


def _names(schema: str) -> list[str]:
    """The column names of a schema string, whose types may hold commas themselves."""
    names, depth = [], 0
    for column in schema.split(", "):
        if not depth:
            names.append(column.split()[0])
        depth += column.count("<") - column.count(">")
    return names


def _row(schema: str) -> Row:
    """A row class with the column names of a schema string."""
    return Row(*_names(schema))


def _maker(names: list[str]) -> Callable[[Iterable], Row]:
    """What makes a row of a sequence of values, with its columns as plain attributes: quicker to make and read than ``Row``."""
    places = {c: i for i, c in reversed([*enumerate(names)])}
    columns = {c: property(itemgetter(i)) for c, i in places.items() if not hasattr(Row, c)}

    def value(self, c):
        return tuple.__getitem__(self, places.get(c, c))

    return partial(tuple.__new__, type("Row", (Row,), {**columns, "__fields__": names, "__getitem__": value}))


def _values(column: pa.Array, nested: bool) -> list:
    """The values of a column from Arrow: numbers by way of numpy, and each different string made once."""
    if not column.null_count:
        kind = column.type
        if pa.types.is_integer(kind) or pa.types.is_floating(kind):
            return column.to_numpy().tolist()
        if pa.types.is_string(kind):
            coded = column.dictionary_encode()
            return list(map(coded.dictionary.to_pylist().__getitem__, coded.indices.to_numpy().tolist()))
    values = column.to_pylist()
    return _plain(values) if nested else values


def _plain(v):
    """A value from Arrow, with structs as tuples."""
    if isinstance(v, dict):
        return tuple(_plain(x) for x in v.values())
    return [_plain(x) for x in v] if isinstance(v, list) else v


def _pack(v) -> bytes:
    return pickle.dumps(v, 5)


_NAN = float("nan")


def _frozen(v):
    """A key as Spark groups by it, fit for a dict: arrays as tuples, and NaN equal to itself."""
    if isinstance(v, (list, tuple)):
        return tuple(_frozen(x) for x in v)
    return _NAN if v != v else v


class Automaton:
    """State is a tuple with the fields of ``state``; ``begin`` gives the first one."""

    state: str
    output: str  # columns after the key

    def begin(self) -> tuple:
        raise NotImplementedError

    def row(self, s: tuple, r: Row) -> tuple[tuple, Out]:
        raise NotImplementedError

    def deadline(self, s: tuple) -> int | None:
        return None

    def fire(self, s: tuple, t: int) -> tuple[tuple, Out]:
        return s, []


class SortedRun:
    """Ordered rows of a key in blocks of state, read block by block; what has been read is removed. A few rows that are
    left of the last block are ``rest``."""

    def __init__(self, blocks, us: int, number: int, at: int, n: int, first: int):
        self.blocks, self.us, self.number, self.at, self.n, self.first = blocks, us, number, at, n, first
        self.rest: list[tuple] = []

    def upto(self, us: int) -> Iterator[tuple]:
        """The rows up to a time. ``first`` is then the time of the first row left."""
        while self.first <= us and self.at < self.n:
            rows = pickle.loads(self.blocks.getValue((self.number, self.at))[0])
            for i, r in enumerate(rows):
                if r[self.us] > us:
                    self.first = r[self.us]
                    if self.at == self.n - 1 and len(rows) - i <= InOrder.FEW_ROWS:
                        self.rest = rows[i:]
                        break
                    if i:
                        self.blocks.updateValue((self.number, self.at), (_pack(rows[i:]),))
                    return
                yield r
            self.blocks.removeKey((self.number, self.at))
            self.at += 1


class InOrder(StatefulProcessor):
    PAGE_ROWS = 20_000
    BLOCK_ROWS = 2_000
    FEW_ROWS = 2_000  # as many as a block: they cost one value, not three calls more

    def __init__(
        self, automaton: Automaton, keys: list[str], columns: list[str], nested: bool, output: str, us: str, slot: int,
        tie: str | None,
    ):
        self.automaton, self.columns, self.nested, self.output = automaton, columns, nested, output
        self.keys, self.slot, self.us = len(keys), slot, columns.index(us)
        self.order = itemgetter(self.us, columns.index(tie)) if tie else itemgetter(self.us)
        self.timed = type(automaton).deadline is not Automaton.deadline

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        run = "struct<number: bigint, at: bigint, n: bigint, first: bigint>"
        self.waiting = handle.getValueState("waiting", f"few binary, runs array<{run}>, number bigint, timer bigint, seen bigint")
        self.blocks = handle.getMapState("blocks", "run bigint, block bigint", "waiting binary")
        self.held = handle.getValueState("held", "held binary")
        self.seen = handle.getValueState("seen", "us bigint")  # of a group in which nothing waits

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._wait(timerValues, *self._arrive(rows))
        return iter([])

    def visit(self, key, rows, timerValues) -> Iterator[list[tuple]]:
        """Take rows and work off what is over, so that the timer need not: the results in pages."""
        few, runs, _, timer = waiting = self._arrive(rows)
        due = [t for t in (timer, self._wake(few, runs)) if t is not None]
        if due and min(due) <= timerValues.getCurrentWatermarkInMs():
            yield from self.pages(key, timerValues, waiting)
        else:
            self._wait(timerValues, *waiting)

    def _arrive(self, rows) -> tuple[list[tuple], list[SortedRun], int, int | None]:
        few, runs, number, timer, late = self._waiting()
        if timer is None:
            seen = self.seen.get()
            late = seen[0] if seen else 0  # as Spark, which begins with a watermark of 0
        for r in rows:
            few += self._arrived(r, late)
            if len(few) >= self.PAGE_ROWS:
                runs.append(self._store(few, number))
                few, number = [], number + 1
        if len(few) > self.FEW_ROWS:
            runs.append(self._store(few, number))
            few, number = [], number + 1
        return few, runs, number, timer

    def _arrived(self, r: Row, late: int) -> list[tuple]:
        """The rows of a pack that are not late, or a row that came by itself: of those Spark has dropped the late ones."""
        if PACK not in r.__fields__:
            return [tuple(_plain(r[c]) for c in self.columns)]
        us, pack = self.us, pa.ipc.open_stream(r[PACK]).read_all().combine_chunks()
        columns = [_values(c.chunk(0), self.nested) for c in pack.columns] if pack.num_rows else []
        return [v for v in zip(*columns) if v[us] > late]

    def _waiting(self) -> tuple[list[tuple], list[SortedRun], int, int | None, int]:
        was = self.waiting.get()
        if was is None:
            return [], [], 0, None, 0
        few, runs, number, timer, seen = was
        return pickle.loads(few), [SortedRun(self.blocks, self.us, *r) for r in runs], number, timer, seen

    def _store(self, rows: list[tuple], number: int) -> SortedRun:
        rows.sort(key=self.order)
        n = -(-len(rows) // self.BLOCK_ROWS)
        for i in range(n):
            self.blocks.updateValue((number, i), (_pack(rows[i * self.BLOCK_ROWS : (i + 1) * self.BLOCK_ROWS]),))
        return SortedRun(self.blocks, self.us, number, 0, n, rows[0][self.us])

    def _wake(self, few: list[tuple], runs: list[SortedRun], deadline: int | None = None) -> int | None:
        ahead = [*(r[self.us] for r in few), *(run.first for run in runs), *([] if deadline is None else [deadline])]
        return (min(ahead) // self.slot + 1) * self.slot // 1000 if ahead else None

    def _wait(
        self, timerValues, few: list[tuple], runs: list[SortedRun], number: int, timer: int | None, deadline: int | None = None
    ) -> None:
        """Keep what waits with the watermark seen, and one timer: at the end of the first slot with a row or a deadline."""
        seen = timerValues.getCurrentWatermarkInMs() * 1000
        wake = self._wake(few, runs, deadline)
        if wake is not None and (timer is None or wake < timer):
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wake)
            timer = wake
        if timer is None:
            self.waiting.clear()
            self.seen.update((seen,))
        else:
            self.waiting.update((_pack(few), [(r.number, r.at, r.n, r.first) for r in runs], number, timer, seen))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[tuple]:
        return chain.from_iterable(self.pages(key, timerValues))

    def pages(self, key, timerValues, waiting: tuple | None = None) -> Iterator[list[tuple]]:
        """The results of all slots that are over, in lists of about a page; ``waiting`` is what waits, with a timer that is
        still to come."""
        now = timerValues.getCurrentWatermarkInMs() * 1000
        over = now - now % self.slot - 1  # last instant of the newest slot that is over
        few, runs, number, timer = waiting or (*self._waiting()[:3], None)
        few.sort(key=self.order)
        ripe = bisect_right(few, over, key=itemgetter(self.us))
        was = self.held.get()
        held = {_frozen(k): s for k, s in pickle.loads(was[0])} if was else {}
        due: dict[tuple, int | None] = {}  # the deadlines of the automata met here
        make, n, us, most = _maker(self.columns[self.keys :]), self.keys, self.us, self.PAGE_ROWS
        row, deadline, timed, begin = self.automaton.row, self.automaton.deadline, self.timed, self.automaton.begin
        out: Out = []
        found: list[tuple] = []
        for r in self._merged(runs, few[:ripe], over):
            k = r[:n]
            if k not in held:
                k = _frozen(k)
                if k not in held:
                    held[k] = begin()
            s = held[k]
            if timed:
                t = due[k] if k in due else deadline(s)
                if t is not None and t < r[us]:
                    s, _ = self._fire(s, t, r[us] - 1, out)
                    found += [k + o for o in out]
                    out.clear()
            s, more = row(s, make(r[n:]))
            held[k] = s
            if timed:
                due[k] = deadline(s)
            if more:
                found += [k + o for o in more]
            if len(found) >= most:
                yield found
                found = []
        ahead, first = None, begin()
        for k, s in list(held.items()):
            t = None
            if timed:
                t = due[k] if k in due else deadline(s)
                if t is not None and t <= over:  # no row can come before these deadlines any more
                    s, t = self._fire(s, t, over, out)
                    held[k] = s
                    found += [k + o for o in out]
                    out.clear()
                    if len(found) >= most:
                        yield found
                        found = []
            if s == first:
                del held[k]
            elif t is not None and (ahead is None or t < ahead):
                ahead = t
        if found:
            yield found
        if held:
            self.held.update((_pack(list(held.items())),))
        elif was:
            self.held.clear()
        if timer is not None:
            self.handle.deleteTimer(timer)
        few = [*chain.from_iterable(run.rest for run in runs), *few[ripe:]]
        runs = [run for run in runs if run.at < run.n]
        self._wait(timerValues, few, runs, number if runs else 0, None, ahead)

    def _merged(self, runs: list[SortedRun], few: list[tuple], over: int) -> Iterable[tuple]:
        """The rows of runs up to a time and ``few`` more, in order: sorted at once if they fit a page, or block by block."""
        parts = [run.upto(over) for run in runs if run.first <= over]
        if sum(run.n - run.at for run in runs if run.first <= over) * self.BLOCK_ROWS > self.PAGE_ROWS:
            return heapq.merge(*parts, few, key=self.order)
        return sorted(chain(*parts, few), key=self.order)

    def close(self) -> None:
        pass

    def _fire(self, s: tuple, t: int | None, upto: int, out: Out) -> tuple[tuple, int | None]:
        """Fire the deadlines up to a time, ``t`` the first of them; the automaton then, and its next deadline."""
        fire, deadline = self.automaton.fire, self.automaton.deadline
        while t is not None and t <= upto:
            s, more = fire(s, t)
            out += more
            t = deadline(s)
        return s, t


class Packed(StatefulProcessor):
    """``InOrder`` with its results packed: ``(__rows)``, up to a page and what a row adds to it as a stream of Arrow."""

    def __init__(self, inner: InOrder, schema: pa.Schema):
        self.inner, self.schema = inner, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.inner.init(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self._packed(self.inner.visit(key, rows, timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._packed(self.inner.pages(key, timerValues))

    def _packed(self, pages: Iterator[list[tuple]]) -> Iterator[Row]:
        for page in pages:
            columns = [pa.array(c, t) for c, t in zip(zip(*page), self.schema.types)]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.schema) as stream:
                stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            yield Row(**{PACK: sink.getvalue().to_pybytes()})

    def close(self) -> None:
        self.inner.close()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pack in batch.column(0):
            yield from pa.ipc.open_stream(pack.as_buffer())


# Keys go in so many groups, each visited once a micro-batch: a call to the state store costs as much as many rows.
GROUPS = 512
PACK = "__rows"
PACK_FROM_ROWS, PACK_FROM_BYTES = 1 << 18, 32 << 20  # what a task gathers before it packs the rows of each group


def _packs(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows of a micro-batch as ``(__group, __rows)``: some of one group, in their order, as a stream of Arrow."""
    most = InOrder.PAGE_ROWS

    def packed(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        group = rows.column(0).to_numpy()
        order = np.argsort(group, kind="stable")
        rows, group = rows.select(range(1, rows.num_columns)).take(pa.array(order)), group[order]
        heads = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        found: list[tuple[int, bytes]] = []
        for a, b in zip(heads, [*heads[1:], len(group)]):
            for at in range(a, b, most):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as stream:
                    stream.write_table(rows.slice(at, min(most, b - at)))
                found.append((int(group[a]), sink.getvalue().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.binary()))], ["__group", PACK])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= PACK_FROM_ROWS or size >= PACK_FROM_BYTES:
                yield from packed(held)
                held, n, size = [], 0, 0
        if n:
            yield from packed(held)

    group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).alias("__group")
    return df.select(group, *columns).mapInArrow(pack, f"__group bigint, {PACK} binary")


def in_order(
    df: DataFrame,
    keys: list[str],
    automaton: Automaton,
    slot: int = SECOND,
    ts: str = "ts",
    us: str = "us",
    tie: str | None = None,
) -> DataFrame:
    """Run an automaton per key over a stream with a watermark on ``ts``. Results come when the
    watermark passes the end of their ``slot`` (whole milliseconds); ``tie`` orders equal times."""
    columns = [*keys, *[c for c in df.columns if c not in (*keys, ts)]]
    output = f"{_columns(df, keys)}, {automaton.output}"
    nested = any("<" in df.schema[c].dataType.simpleString() for c in columns)
    processor = InOrder(automaton, keys, columns, nested, output, us, slot, tie)
    packed = Packed(processor, to_arrow_schema(T.StructType.fromDDL(output)))
    grouped = _packs(df, keys, columns).groupBy("__group")
    return grouped.transformWithState(packed, f"{PACK} binary", "Append", "EventTime").mapInArrow(_unpack, output)


class HitRun(Automaton):
    """A row completing at least ``n`` hits in a row."""

    state, output = "run bigint", "us bigint"

    def __init__(self, hit: Callable[[Row], bool], n: int = 3):
        self.hit, self.n = hit, n

    def begin(self):
        return (0,)

    def row(self, s, r):
        run = s[0] + 1 if self.hit(r) else 0
        return (run,), [(r.us,)] if run >= self.n else []


class Sequence(Automaton):
    """Strict sequence of stages with an optional time limit: (times, tag) per match or timeout."""

    state, output = "open array<array<bigint>>", "times array<bigint>, tag string"

    def __init__(self, stages: list[Callable[[Row], bool]], within: int | None = None):
        self.stages, self.within = stages, within

    def begin(self):
        return ([],)

    def row(self, s, r):
        out, still = [], []
        for times in [*s[0], []]:
            if times and self.within is not None and r.us - times[0] >= self.within:
                out.append((times, "timeout"))
            elif self.stages[len(times)](r):
                grown = [*times, r.us]
                if len(grown) == len(self.stages):
                    out.append((grown, "match"))
                else:
                    still.append(grown)
        return (still,), out

    def deadline(self, s):
        return min(t[0] for t in s[0]) + self.within if s[0] and self.within is not None else None

    def fire(self, s, t):
        late = [x for x in s[0] if x[0] + self.within <= t]
        return ([x for x in s[0] if x[0] + self.within > t],), [(x, "timeout") for x in late]


class Stages(Automaton):
    """Strict sequence of rows: row i of a match has ``is_<i>`` set. Emits the rows so far and ``match``, or
    ``timeout`` for a sequence that has not ended within ``within``. See ``operators.pattern``."""

    def __init__(self, n: int, columns: list[str], types: list[str], within: int | None = None):
        self.n, self.columns, self.within = n, columns, within
        item = ", ".join(f"{c}: {t}" for c, t in zip(["__us", *columns], ["bigint", *types]))
        self.state = f"open array<array<struct<{item}>>>"
        self.output = f"events array<struct<{item}>>, tag string"

    def begin(self):
        return ([],)

    def row(self, s, r):
        item = (r["__us"], *[r[c] for c in self.columns])
        out, still = [], []
        for rows in [*s[0], []]:
            if rows and self.within is not None and r["__us"] - rows[0][0] >= self.within:
                out.append((rows, "timeout"))
            elif r[f"is_{len(rows)}"]:
                grown = [*rows, item]
                if len(grown) == self.n:
                    out.append((grown, "match"))
                else:
                    still.append(grown)
        return (still,), out

    def deadline(self, s):
        return min(x[0][0] for x in s[0]) + self.within if s[0] and self.within is not None else None

    def fire(self, s, t):
        late = [x for x in s[0] if x[0][0] + self.within <= t]
        return ([x for x in s[0] if x[0][0] + self.within > t],), [(x, "timeout") for x in late]


class OrderTimeout(Automaton):
    """Payments as paid; a key that begins with a create and is not paid in time as timeout."""

    state, output = "begun boolean, due bigint", "us bigint, tag string"

    def __init__(self, is_create: Callable[[Row], bool], is_pay: Callable[[Row], bool], timeout: int):
        self.is_create, self.is_pay, self.timeout = is_create, is_pay, timeout

    def begin(self):
        return (False, None)

    def row(self, s, r):
        if self.is_pay(r):
            return (True, None), [(r.us, "paid")]
        if self.is_create(r) and not s[0]:
            return (True, r.us + self.timeout), []
        return s, []

    def deadline(self, s):
        return s[1]

    def fire(self, s, t):
        return (True, None), [(t, "timeout")]


class RisingAlert(Automaton):
    """Value not fallen for ``hold`` after a rise."""

    state, output = "last double, due bigint", "alert_us bigint"

    def __init__(self, value: str, hold: int):
        self.value, self.hold = value, hold

    def begin(self):
        return (None, None)

    def row(self, s, r):
        last, due = s
        if r[self.value] is None:
            return s, []
        v = float(r[self.value])
        if last is not None and v < last:
            due = None
        elif last is not None and v > last and due is None:
            due = r.us + self.hold
        return (v, due), []

    def deadline(self, s):
        return s[1]

    def fire(self, s, t):
        return (s[0], None), [(t,)]


class Gate(Automaton):
    """Data rows that find the gate open. Opening rows must sort before data rows of the same time."""

    state, output = "open boolean, closes array<bigint>", "event_id bigint, us bigint"

    def __init__(self, opens: Callable[[Row], bool], duration: int):
        self.opens, self.duration = opens, duration

    def begin(self):
        return (False, [])

    def row(self, s, r):
        is_open, closes = s
        if self.opens(r):
            return (r.us not in closes, [t for t in closes if t > r.us] + [r.us + self.duration]), []
        if r.us in closes:
            is_open, closes = False, [t for t in closes if t > r.us]
        return (is_open, closes), [(r.event_id, r.us)] if is_open else []

    def deadline(self, s):
        return min(s[1], default=None)

    def fire(self, s, t):
        return (False, [c for c in s[1] if c > t]), []


class Reconcile(Automaton):
    """Two sides, at most one row per side and key, matched when no more than ``timeout`` apart."""

    state, output = "l bigint, r bigint", "left_us bigint, right_us bigint, outcome string"

    def __init__(self, is_left: Callable[[Row], bool], timeout: int):
        self.is_left, self.timeout = is_left, timeout

    def begin(self):
        return (None, None)

    def row(self, s, r):
        left, right = s
        if self.is_left(r):
            if right is not None:
                return (None, None), [(r.us, right, "left_first" if r.us <= right else "right_first")]
            return (r.us, None), []
        if left is not None:
            return (None, None), [(left, r.us, "left_first")]
        return (None, r.us), []

    def deadline(self, s):
        waiting = s[0] if s[0] is not None else s[1]
        return None if waiting is None else waiting + self.timeout

    def fire(self, s, t):
        return (None, None), [(s[0], s[1], "left_only" if s[0] is not None else "right_only")]


class ReconcileNth(Automaton):
    """The n-th row of one side with the n-th row of the other, matched when no more than ``timeout`` apart.

    Both sides come as one tagged input, in order. A row waits with a deadline of its own; at the deadline it is
    left over, and so is a row that comes after its partner has been. What waits is bounded by the rows of a
    timeout; of the rest only the two counts are kept."""

    state = "n_left bigint, n_right bigint, lefts array<struct<n: bigint, us: bigint>>, rights array<struct<n: bigint, us: bigint>>"
    output = "n bigint, left_us bigint, right_us bigint, outcome string"

    def __init__(self, is_left: Callable[[Row], bool], timeout: int):
        self.is_left, self.timeout = is_left, timeout

    def begin(self):
        return (0, 0, [], [])

    def row(self, s, r):
        n_left, n_right, lefts, rights = s
        if self.is_left(r):
            n_left += 1
            mine, others, n = lefts, rights, n_left
        else:
            n_right += 1
            mine, others, n = rights, lefts, n_right
        out = []
        if others and others[0][0] == n:  # both sides are queues, so a waiting partner is the oldest
            t = others[0][1]
            others = others[1:]
            left_us, right_us = (r.us, t) if self.is_left(r) else (t, r.us)
            out.append((n, left_us, right_us, "left_first" if left_us <= right_us else "right_first"))
        elif n <= (n_right if self.is_left(r) else n_left):  # the partner has been and gone
            out.append((n, r.us, None, "left_only") if self.is_left(r) else (n, None, r.us, "right_only"))
        else:
            mine = [*mine, (n, r.us)]
        lefts, rights = (mine, others) if self.is_left(r) else (others, mine)
        return (n_left, n_right, lefts, rights), out

    def deadline(self, s):
        return min((q[0][1] + self.timeout for q in s[2:] if q), default=None)

    def fire(self, s, t):
        n_left, n_right, lefts, rights = s
        out = [(n, us, None, "left_only") for n, us in lefts if us + self.timeout <= t]
        out += [(n, None, us, "right_only") for n, us in rights if us + self.timeout <= t]
        return (n_left, n_right, *([x for x in q if x[1] + self.timeout > t] for q in (lefts, rights))), out


class EarlyFire(Automaton):
    """Counts of a tumbling window at every tick and, complete, at end - 1. ``tick=None`` gives the
    complete count only. Rows are in order, so one window per key is open at a time."""

    state = "window_start bigint, cnt bigint, next bigint"
    output = "window_start bigint, fired_at bigint, cnt bigint"

    def __init__(self, size: int, tick: int | None = None):
        self.size, self.tick = size, tick

    def begin(self):
        return (None, 0, None)

    def row(self, s, r):
        start = r.us - r.us % self.size
        if s[0] is None:
            first = r.us - r.us % self.tick + self.tick if self.tick else start + self.size - 1
            return (start, 1, min(first, start + self.size - 1)), []
        return (start, s[1] + 1, s[2]), []

    def deadline(self, s):
        return s[2]

    def fire(self, s, t):
        start, n, _ = s
        last = start + self.size - 1
        after = self.begin() if t == last else (start, n, min(t + self.tick, last))
        return after, [(start, t, n)]


class ElementTimers(Automaton):
    """One timer per instant ``us + after``; the row it leads to is emitted when it fires. Rows come in
    order and the delay is constant, so the timers are a queue: ``head`` of them have fired."""

    state, output = "timers array<bigint>, head bigint", "timer bigint"

    def __init__(self, after: int):
        self.after = after

    def begin(self):
        return ([], 0)

    def row(self, s, r):
        timers, head = s
        t = r.us + self.after
        if not timers or timers[-1] != t:
            timers.append(t)
        return (timers, head), []

    def deadline(self, s):
        return s[0][s[1]] if s[1] < len(s[0]) else None

    def fire(self, s, t):
        timers, head = s[0], s[1] + 1
        if 2 * head > len(timers):
            timers, head = timers[head:], 0
        return (timers, head), [(t,)]


class Stats(Automaton):
    """Count, sum, minimum and maximum after every row."""

    state = "cnt bigint, total bigint, low bigint, high bigint"
    output = "us bigint, cnt bigint, total bigint, low bigint, high bigint"

    def __init__(self, value: str):
        self.value = value

    def begin(self):
        return (0, 0, None, None)

    def row(self, s, r):
        n, total, low, high = s
        v = int(r[self.value])
        s = (n + 1, total + v, v if low is None else min(low, v), v if high is None else max(high, v))
        return s, [(r.us, *s)]


class CountChanges(Automaton):
    """Row kinds of a running count: +I for the first row of a key, then -U old and +U new."""

    state = "cnt bigint"

    def __init__(self, seq: str):
        self.seq, self.output = seq, f"{seq} bigint, row_kind string, cnt bigint"

    def begin(self):
        return (0,)

    def row(self, s, r):
        n, seq = s[0], r[self.seq]
        return (n + 1,), [(seq, "-U", n), (seq, "+U", n + 1)] if n else [(seq, "+I", 1)]


class ProcessingTimers(StatefulProcessor):
    """A processing-time timer ``after_ms`` behind every row; rows at one instant share a timer."""

    def __init__(self, after_ms: int, output: str):
        self.after_ms, self.output = after_ms, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        n = sum(1 for _ in rows)
        if n:
            self.handle.registerTimer(now + self.after_ms)
        return iter([_row(self.output)(*key, "seen", n, now)] if n else [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter([_row(self.output)(*key, "fired", 1, expiredTimerInfo.getExpiryTimeInMs())])

    def close(self) -> None:
        pass


def processing_timers(df: DataFrame, key: str, after_ms: int) -> DataFrame:
    """Run with a processing-time trigger and stop it yourself: such a query never ends on its own."""
    output = f"{_columns(df, [key])}, what string, n bigint, at_ms bigint"
    return df.groupBy(key).transformWithState(ProcessingTimers(after_ms, output), output, "Append", "ProcessingTime")


class LateTag(StatefulProcessor):
    """Rows with a flag telling whether their time is below the watermark of their micro-batch."""

    def __init__(self, columns: list[str], us: str, output: str):
        self.columns, self.us, self.output = columns, us, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        make = _row(self.output)
        return (make(*key, *[r[c] for c in self.columns], r[self.us] < wm) for r in rows)

    def close(self) -> None:
        pass


def tag_late(df: DataFrame, keys: list[str], ts: str = "ts", us: str = "us") -> DataFrame:
    """Late rows kept and flagged. ``ts`` carries the watermark and is dropped before the operator:
    Spark removes late rows only from operators that still see the event-time column."""
    columns = [c for c in df.columns if c not in (*keys, ts)]
    output = f"{_columns(df, [*keys, *columns])}, is_late boolean"
    processor = LateTag(columns, us, output)
    return df.drop(ts).groupBy(*keys).transformWithState(processor, output, "Append", "EventTime")


class CountWindows(StatefulProcessor):
    """Tumbling counts by hand: a map from window start to count, and a timer at each window's end. No row is kept."""

    def __init__(self, size: int, us: str, output: str):
        self.size, self.us, self.output = size, us, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "start bigint", "cnt bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, int] = {}
        for r in rows:
            start = r[self.us] - r[self.us] % self.size
            new[start] = new.get(start, 0) + 1
        for start, n in new.items():
            held = self.counts.containsKey((start,))
            self.counts.updateValue((start,), ((self.counts.getValue((start,))[0] if held else 0) + n,))
            if not held:
                self.handle.registerTimer((start + self.size) // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.size
        out = [_row(self.output)(*key, start, self.counts.getValue((start,))[0])]
        self.counts.removeKey((start,))
        return iter(out)

    def close(self) -> None:
        pass


SALTS = 32


def count_windows(df: DataFrame, keys: list[str], size: int, ts: str = "ts", us: str = "us") -> DataFrame:
    """Partial counts (keys, salt, window_start, cnt) of tumbling windows, at most SALTS of them a key and window, so
    that a hot key is spread over tasks. All parts of a window leave in the same micro-batch: add them up in
    foreachBatch with ``whole_windows``. ``size`` in whole milliseconds."""
    salt = F.pmod(F.xxhash64(us), F.lit(SALTS)).cast("int").alias("salt")
    output = f"{_columns(df, keys)}, salt int, window_start bigint, cnt bigint"
    salted = df.select(*keys, ts, us, salt).groupBy(*keys, "salt")
    return salted.transformWithState(CountWindows(size, us, output), output, "Append", "EventTime")


def whole_windows(parts: DataFrame, keys: list[str], size: int) -> DataFrame:
    whole = parts.groupBy(*keys, "window_start").agg(F.sum("cnt").alias("cnt"))
    return whole.select(*keys, "window_start", (F.col("window_start") + F.lit(size)).alias("window_end"), "cnt")


class LateWindow(StatefulProcessor):
    """One tumbling window per key (the key includes its end): first firing, one more firing per
    row late by no more than ``lateness``, a side output for rows later than that."""

    def __init__(self, lateness: int, output: str):
        self.lateness, self.output = lateness, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counted = handle.getValueState("counted", "cnt bigint, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        make = _row(self.output)
        wm, end = timerValues.getCurrentWatermarkInMs() * 1000, key[-1]
        n = sum(1 for _ in rows)
        cnt, fired = self.counted.get() if self.counted.exists() else (0, False)
        if wm >= end + self.lateness:
            return iter([make(*key, "side_output", n)] if n else [])
        out = []
        if wm < end:
            cnt += n
            self.handle.registerTimer(-(-end // 1000))
        else:
            if cnt and not fired:
                out.append(make(*key, "first", cnt))
                fired = True
            for _ in range(n):
                cnt += 1
                out.append(make(*key, "refire" if fired else "first", cnt))
                fired = True
        self.handle.registerTimer(-(-(end + self.lateness) // 1000))
        self.counted.update((cnt, fired))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        out, make = [], _row(self.output)
        if self.counted.exists():
            cnt, fired = self.counted.get()
            if cnt and not fired:
                out.append(make(*key, "first", cnt))
                self.counted.update((cnt, True))
            if timerValues.getCurrentWatermarkInMs() * 1000 >= key[-1] + self.lateness:
                self.counted.clear()
        return iter(out)

    def close(self) -> None:
        pass


def late_windows(
    df: DataFrame, keys: list[str], size: int, lateness: int = 0, ts: str = "ts", us: str = "us"
) -> DataFrame:
    """Window counts with allowed lateness and side output; ``lateness=0`` is the plain late side
    output. The watermark moves once per micro-batch, so all rows of one see the same."""
    end = (F.col(us) - F.pmod(F.col(us), F.lit(size)) + F.lit(size)).alias("window_end")
    output = f"{_columns(df, keys)}, window_end bigint, kind string, cnt bigint"
    windowed = df.select(*keys, end).groupBy(*keys, "window_end")
    return windowed.transformWithState(LateWindow(lateness, output), output, "Append", "EventTime")
