"""Patterns of rows in strict sequence, written once and run on tables and on streams.

    burst = (Pattern.begin("fails", F.col("event_type") == "error").times(2)
             .next("recovered", F.col("event_type") == "view").within(6 * HOUR))
    found = burst.match(events, ["user_id"], ["us"], ["event_id", "us"])

A stage has a name, a condition (a boolean column) and a number of times. The stages of a pattern follow each other
without a row of the key between them; matches may overlap and are all kept. With ``within``, the last row must
come less than that after the first; a sequence that has begun and sees no further row in time is a timeout.

A match is a map from the name of a stage to its rows, oldest first: ``match map<string, array<struct<...>>>``, and
``tag`` (match or timeout). A timeout has only the stages that it reached. ``select_each`` makes any number of rows
of a match.

On a table the pattern becomes neighbouring rows (``ordered.shifted``, which survives hot keys), on a stream an
automaton per key (``stateful.Stages``) that holds the rows of open sequences only.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.patterns import match_recognize


@dataclass(frozen=True)
class Stage:
    name: str
    where: Column
    n: int = 1


@dataclass(frozen=True)
class Pattern:
    stages: tuple[Stage, ...]
    limit: int | None = None

    @staticmethod
    def begin(name: str, where: Column) -> Pattern:
        return Pattern((Stage(name, where),))

    def next(self, name: str, where: Column) -> Pattern:
        if name in (s.name for s in self.stages):
            raise ValueError(f"stage {name!r} is there already")
        return replace(self, stages=(*self.stages, Stage(name, where)))

    def times(self, n: int) -> Pattern:
        """The last stage ``n`` times in a row."""
        if n < 1:
            raise ValueError("a stage stands at least once")
        return replace(self, stages=(*self.stages[:-1], replace(self.stages[-1], n=n)))

    def within(self, us: int) -> Pattern:
        return replace(self, limit=us)

    def places(self) -> list[Stage]:
        """The stage of every row of a match."""
        return [s for s in self.stages for _ in range(s.n)]

    def match(self, df: DataFrame, keys: list[str], order: list[str], columns: list[str], us: str = "us") -> DataFrame:
        """``(keys, match, tag)`` on a table. Null times are in no match."""
        named = [(f"__{i}", lambda col, c=s.where: F.coalesce(c, F.lit(False))) for i, s in enumerate(self.places())]
        if len(named) == 1:
            one = df.filter(F.coalesce(self.stages[0].where, F.lit(False)))
            return one.select(*keys, self._map(F.array(F.struct(*columns))), F.lit("match").alias("tag"))
        measures = list(dict.fromkeys([*columns, us]))
        found = match_recognize(df, keys, order, named, measures, self.limit, us)
        rows = [F.when(F.col(f"{n}_{us}").isNotNull(), F.struct(*[F.col(f"{n}_{c}").alias(c) for c in columns])) for n, _ in named]
        return found.select(*keys, self._map(F.array_compact(F.array(*rows))), "tag")

    def match_stream(self, df: DataFrame, keys: list[str], columns: list[str], slot: int, ts: str = "ts", us: str = "us") -> DataFrame:
        """The same on a stream with a watermark on ``ts``; results come when the watermark passes a ``slot``."""
        from tidemark.streaming import stateful

        places = self.places()
        flags = [F.coalesce(s.where, F.lit(False)).alias(f"is_{i}") for i, s in enumerate(places)]
        rows = df.select(*keys, ts, F.col(us).alias("__us"), *columns, *flags)
        types = [rows.schema[c].dataType.simpleString() for c in columns]
        automaton = stateful.Stages(len(places), columns, types, self.limit)
        found = stateful.in_order(rows, keys, automaton, slot=slot, ts=ts, us="__us")
        events = F.transform("events", lambda e: F.struct(*[e[c].alias(c) for c in columns]))
        return found.select(*keys, self._map(events), "tag")

    def _map(self, events: Column) -> Column:
        """Rows of a match by stage; stages that were not reached are not there."""
        parts, at = [], 1
        for s in self.stages:
            parts += [F.lit(s.name), F.slice(events, at, s.n)]
            at += s.n
        return F.map_filter(F.create_map(*parts), lambda _, rows: F.size(rows) > 0).alias("match")


def select_each(matches: DataFrame, rows: Column, keep: list[str]) -> DataFrame:
    """Zero or more rows per match: ``rows`` is an array of structs made from the columns of the match."""
    return matches.select(*keep, F.explode(rows).alias("__r")).select(*keep, "__r.*")
