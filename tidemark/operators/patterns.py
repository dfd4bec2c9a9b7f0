"""Event patterns per key: strict sequences, time limits, timeouts, runs of rising values."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sizing import settle
from tidemark.operators.ordered import running, shifted
from tidemark.session import scratch_root

Stage = tuple[str, Callable[[Callable[[str], Column]], Column]]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def match_recognize(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    stages: list[Stage],
    measures: list[str],
    within: int | None = None,
    us: str = "us",
) -> DataFrame:
    """Matches of a strict sequence: one row per stage, adjacent within the key, overlaps kept.

    ``stages`` are (name, predicate); a predicate gets a function from column name to Column.
    Output: keys, ``<stage>_<measure>`` columns and ``tag``. Without ``within`` every tag is match.
    With it the whole sequence must take less than ``within``; a sequence that begins and then sees
    no further row in time is tagged timeout with nulls for the stages it lacks; one that meets a
    row of the wrong kind in time gives nothing.
    """
    outputs: dict[str, tuple[str, int]] = {}
    flags = {f"__is_{i}": pred(F.col) for i, (_, pred) in enumerate(stages)}
    for i, (name, _) in enumerate(stages[1:], start=1):
        outputs[f"__ok_{i}"] = (f"__is_{i}", i)
        outputs[f"__us_{i}"] = (us, i)
        outputs |= {f"{name}_{m}": (m, i) for m in measures}
    rows = shifted(df.withColumns(flags), keys, order, outputs).filter(F.col("__is_0"))
    first = stages[0][0]
    rows = rows.withColumns({f"{first}_{m}": F.col(m) for m in measures})
    steps = range(1, len(stages))
    wanted = [f"{name}_{m}" for name, _ in stages for m in measures]
    in_time = [
        F.lit(True) if within is None else F.coalesce(F.col(f"__us_{i}") - F.col(us) < F.lit(within), F.lit(False))
        for i in steps
    ]
    good = [t & F.coalesce(F.col(f"__ok_{i}"), F.lit(False)) for i, t in zip(steps, in_time)]
    tag = F.when(_all(good), "match")
    if within is not None:
        for i in steps:
            tag = tag.when(_all([*good[: i - 1], ~in_time[i - 1]]), "timeout")
    found = rows.withColumn("tag", tag).filter(F.col("tag").isNotNull())
    if within is not None:
        reached = [_all(good[:i]) for i in steps]
        late = {f"{n}_{m}": F.when(r, F.col(f"{n}_{m}")) for (n, _), r in zip(stages[1:], reached) for m in measures}
        found = found.withColumns(late)
    return found.select(*keys, *wanted, "tag")


def repeats(df: DataFrame, keys: list[str], order: list[str], is_hit: Column, n: int, us: str = "us") -> DataFrame:
    """Rows that complete ``n`` hits in a row within their key; any other row starts over.
    ``times`` lists the n times, oldest first. Overlapping runs all count."""
    marked = df.withColumn("__hit", is_hit)
    outputs = {f"__h{i}": ("__hit", -i) for i in range(1, n)} | {f"__t{i}": (us, -i) for i in range(1, n)}
    rows = shifted(marked, keys, order, outputs)
    done = rows.filter(_all([F.col("__hit"), *[F.col(f"__h{i}") for i in range(1, n)]]))
    times = F.array(*[F.col(f"__t{i}") for i in range(n - 1, 0, -1)], F.col(us))
    return done.select(*df.columns, times.alias("times"))


def order_timeouts(
    df: DataFrame, keys: list[str], is_create: Column, is_pay: Column, timeout: int, us: str = "us"
) -> DataFrame:
    """Every payment as ``paid``; and ``timeout`` at create + timeout for a key that begins with a
    create and has no payment up to then. One aggregate per key, no ordering."""
    kind = F.when(is_pay, "pay").when(is_create, "create")
    rows = df.select(*keys, F.col(us).alias("us"), kind.alias("kind")).filter(F.col("kind").isNotNull())
    paid = rows.filter(F.col("kind") == "pay").select(*keys, "us", F.lit("paid").alias("tag"))
    heads = rows.groupBy(*keys).agg(
        F.min(F.when(F.col("kind") == "create", F.col("us"))).alias("created"),
        F.min(F.when(F.col("kind") == "pay", F.col("us"))).alias("first_paid"),
    )
    due = F.col("created") + F.lit(timeout)
    unpaid = F.col("created").isNotNull() & (F.col("first_paid").isNull() | (F.col("first_paid") > due))
    return paid.unionByName(heads.filter(unpaid).select(*keys, due.alias("us"), F.lit("timeout").alias("tag")))


def rising_alerts(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    hold: int,
    us: str = "us",
    longest_fold: int = 5_000,
    **cut_options,
) -> DataFrame:
    """Alert when a value has not fallen for ``hold`` after a rise.

    The first rise with no timer running sets one; a fall cancels it; an equal value changes
    nothing; when the timer fires there is an alert and the next rise may set a new one.

    Only rises and falls are kept. Rises up to the next fall form a segment, and within it timers
    start at the first rise, then at the first rise later than start + hold, and so on. Segments of
    at most ``longest_fold`` rises are folded as one small array; longer ones (a value that never
    falls) follow links between rises with joins, see ``_linked_starts``.
    """
    needed = dict.fromkeys([*keys, *order, us, value])
    near = shifted(df.select(*needed), keys, order, {"__was": (value, -1)}, **cut_options)
    moves = near.filter(F.col(value) != F.col("__was")).withColumn("__fall", F.col(value) < F.col("__was"))
    falls_before = {"__seg": ("count", F.when(F.col("__fall"), 1))}
    moves = settle(running(settle(moves), keys, order, falls_before, before=True, **cut_options))
    seg = [*keys, "__seg"]
    rise = F.when(~F.col("__fall"), F.col(us))
    sizes = moves.groupBy(*seg).agg(F.count(rise).alias("n")).filter(F.col("n") > longest_fold).drop("n")
    short, long = moves, None
    if not sizes.isEmpty():
        # long segments hold more than ``longest_fold`` rows each; let Spark choose the join
        short = moves.join(sizes, seg, "left_anti")
        long = moves.join(sizes, seg, "left_semi")
    folded = short.groupBy(*seg).agg(
        F.sort_array(F.collect_list(rise)).alias("rises"), F.max(F.when(F.col("__fall"), F.col(us))).alias("fall")
    )
    starts = F.aggregate(
        "rises",
        F.array().cast("array<bigint>"),
        lambda acc, r: F.when(
            (F.size(acc) == 0) | (r > F.element_at(acc, -1) + F.lit(hold)), F.concat(acc, F.array(r))
        ).otherwise(acc),
    )
    begun = folded.filter(F.size("rises") > 0).select(*keys, "fall", F.explode(starts).alias("start"))
    if long is not None:
        begun = begun.unionByName(_linked_starts(long, seg, us, hold, cut_options).select(*keys, "fall", "start"))
    fires = F.col("start") + F.lit(hold)
    return begun.filter(F.col("fall").isNull() | (F.col("fall") > fires)).select(*keys, fires.alias("alert_us"))


def _linked_starts(moves: DataFrame, seg: list[str], us: str, hold: int, cut_options: dict) -> DataFrame:
    """Timer starts of long segments. Each rise links to the first rise later than it + hold (found
    by one ordered pass); from the first rise the links are followed in doubling steps: after k
    rounds 2^k starts are known. Rounds grow with log2(segment length in time / hold)."""
    scratch_root(moves.sparkSession)  # names the checkpoint folder if nobody did
    rises = moves.filter(~F.col("__fall")).select(*seg, F.col(us).alias("r"))
    asks = rises.select(*seg, (-(F.col("r") + F.lit(hold))).alias("nt"), F.lit(0).alias("kind"), F.col("r").alias("of"))
    there = rises.select(*seg, (-F.col("r")).alias("nt"), F.lit(1).alias("kind"), F.col("r").alias("at"))
    both = asks.unionByName(there, allowMissingColumns=True)
    answered = running(both, seg, ["nt", "kind"], {"nxt": ("last", F.col("at"))}, **cut_options)
    jump = answered.filter((F.col("kind") == 0) & F.col("nxt").isNotNull()).select(*seg, F.col("of").alias("start"), "nxt")
    jump = jump.checkpoint()
    known = rises.groupBy(*seg).agg(F.min("r").alias("start")).checkpoint()
    while True:
        reached = known.join(jump, [*seg, "start"]).select(*seg, F.col("nxt").alias("start")).checkpoint()
        if reached.isEmpty():
            break
        known = known.unionByName(reached)
        second = jump.select(*seg, F.col("start").alias("nxt"), F.col("nxt").alias("two"))
        jump = jump.join(second, [*seg, "nxt"]).select(*seg, "start", F.col("two").alias("nxt")).checkpoint()
    falls = moves.groupBy(*seg).agg(F.max(F.when(F.col("__fall"), F.col(us))).alias("fall"))
    return known.join(falls, seg)
