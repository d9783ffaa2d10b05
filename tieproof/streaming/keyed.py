"""Keyed state over micro-batches: logs of what changed, with timers on event time.

Each job is a step function over the rows of one key in one micro-batch and the
state that the key had before; Spark keeps the state, checkpoints it and hands it
back after a failure. What a step emits is an append-only log, so a job that is
replayed from its checkpoint writes the same rows again.

Rows of a key in one micro-batch are put in order; between batches they are taken
as they come, so a row that is late by more than a batch is judged when it comes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# A step: (key, state or None, rows in order, event time that passed without rows or None) -> (state or None, rows to emit, timer or None).
Step = Callable[[tuple, tuple | None, Iterable[tuple], int | None], tuple[tuple | None, list[tuple], int | None]]


#: Groups of keys. One state and one call of Python hold the keys of a slot, so a batch costs calls for slots, not for keys.
SLOTS = 1 << 12


def stateful(stream: DataFrame, keys: list[str], columns: list[str], order: list[str], step: Step, out: str, state: str,
             event_time: str | None = None, slots: int = SLOTS) -> DataFrame:
    """The log that ``step`` emits over the keys of ``stream``.

    ``columns`` are handed to the step as tuples in ``order``; times as whole
    microseconds, keys as text. ``out`` and ``state`` are schemas; rows are emitted
    behind the key. With ``event_time`` (a column with a watermark) a timer, in
    microseconds, calls the step without rows once the watermark has passed it.
    Keys are dealt by hash into ``slots``; a batch rewrites the states of the slots it meets,
    so a state is one list for each of its fields, which costs little to hand over and to keep.
    """
    n = len(keys)
    names = [c.split()[0] for c in out.split(", ")]
    at = [columns.index(c) for c in order]
    shown = [*[f"_k{i}" for i in range(n)], *[f"_{c}" for c in columns]]

    def run(slot: tuple[Any, ...], frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        places = {r[:n]: r[n:] for r in zip(*held.get)} if held.exists else {}  # key -> timer and state
        clock = None if event_time is None else held.getCurrentWatermarkMs()
        met: dict[tuple, list[tuple]] = {}
        if not held.hasTimedOut:
            for f in frames:
                for r in f[shown].itertuples(index=False, name=None):
                    met.setdefault(r[:n], []).append(r[n:])
        due = [] if clock is None else [k for k, (timer, *_) in places.items() if timer is not None and timer < clock and k not in met]
        emitted = []
        for key in (*met, *due):
            rows = sorted(met.get(key, ()), key=lambda r: tuple(r[i] for i in at))
            before = places.get(key)
            after, log, timer = step(key, None if before is None else before[1:], rows, None if key in met else clock * 1000)
            emitted += [(*key, *r) for r in log]
            if after is None:
                places.pop(key, None)
            else:
                places[key] = None if timer is None else max(timer // 1000, clock + 1), *after
        if places:
            held.update(tuple(map(list, zip(*[(*key, *place) for key, place in places.items()]))))
            timers = [] if clock is None else [timer for timer, *_ in places.values() if timer is not None]
            if timers:
                held.setTimeoutTimestamp(min(timers))
        elif held.exists:
            held.remove()
        if emitted:
            yield pd.DataFrame(emitted, columns=[*keys, *names])

    kinds = dict(stream.dtypes)
    schema = ", ".join([f"{k} string" for k in keys] + [out])
    fields = [f.split() for f in [*[f"k{i} string" for i in range(n)], "timer long", *state.split(", ")]]
    held = ", ".join(f"_{i}_{name} array<{kind}>" for i, (name, kind) in enumerate(fields))
    micro = [F.unix_micros(F.col(c).cast("timestamp")) if kinds[c].startswith("timestamp") else F.col(c) for c in columns]
    rows = stream.select(
        F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int").alias("_slot"),
        *[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c.alias(f"_{name}") for c, name in zip(micro, columns)], *([] if event_time is None else [event_time]))
    timeout = GroupStateTimeout.NoTimeout if event_time is None else GroupStateTimeout.EventTimeTimeout
    log = rows.groupBy("_slot").applyInPandasWithState(run, schema, held, "append", timeout)
    return log.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys], *names)


# --- failed candidates ------------------------------------------------------------


def candidate_log(attempts: DataFrame, park_after: int = 5) -> DataFrame:
    """``session_id, us, event_id, change, attempts``: when a candidate of a pool of failed ones was promoted, demoted or parked.

    A failure makes a candidate (``demoted``); so does one after it had been
    promoted. A success takes it out (``promoted``); with more than ``park_after``
    failures in all it is ``parked``, and stays until it succeeds.
    """

    def step(key, state, rows, passed):
        failures, place = state or (0, "new")
        log = []
        for us, event_id, outcome in rows:
            if outcome == "ok":
                now = "promoted" if failures else "new"
            else:
                failures += 1
                now = "parked" if failures > park_after else "demoted"
            if now != place:
                log.append((us, event_id, now, failures))
            place = now
        return (failures, place), log, None

    return stateful(attempts, ["session_id"], ["ts", "event_id", "outcome"], ["ts", "event_id"], step,
                    "us long, event_id long, change string, attempts long", "failures long, place string")


# --- decision states ----------------------------------------------------------------

# Steps that a record may take, from state to states; a record begins as new.
ALLOWED = {
    "new": ("queued",),
    "queued": ("verifying",),
    "verifying": ("verified", "rejected", "needs_human"),
    "needs_human": ("verified", "rejected"),
}


def state_log(steps: DataFrame, allowed: dict[str, tuple[str, ...]] = ALLOWED, key: str = "doc_id") -> DataFrame:
    """``doc_id, step, state, before, accepted``: every step asked for, and whether it was taken.

    A step that the table does not allow from the state at hand is rejected: the
    record stays where it was. Anything but ``new`` is rejected for a record not seen yet.
    """

    def step(key_, state, rows, passed):
        place, log = (state or (None,))[0], []
        for n, asked in rows:
            fits = asked == "new" if place is None else asked in allowed.get(place, ())
            log.append((n, asked, place, fits))
            place = asked if fits else place
        return (None if place is None else (place,)), log, None

    return stateful(steps, [key], ["step", "state"], ["step", "state"], step,
                    "step int, state string, before string, accepted boolean", "place string")


# --- runs that fall silent ------------------------------------------------------------


def stall_alarms(lines: DataFrame, silent_s: int = 900, ended: tuple[str, ...] = ()) -> DataFrame:
    """``run_id, us, alarm, last_us``: ``stalled`` when a run shows no line for ``silent_s``, ``resumed`` when one follows.

    The alarm is a timer: it is raised when the watermark passes the last line by
    ``silent_s``, without a further line of the run; in a batch that spans a gap
    longer than that it is raised and taken back at once. A run whose last line
    holds a marker of ``ended`` needs no alarm. ``us`` is the event time at which
    the silence had lasted long enough, or the time of the line that ended it.
    """
    span = silent_s * 1_000_000

    def step(key, state, rows, passed):
        last, stalled, over = state or (None, False, False)
        log = []
        if passed is not None and not stalled and not over and last is not None and passed >= last + span:
            log.append((last + span, "stalled", last))
            stalled = True
        for us, _, line in rows:
            if last is not None and us > last + span and not stalled and not over:
                log.append((last + span, "stalled", last))
                stalled = True
            if stalled and us > last:
                log.append((us, "resumed", last))
                stalled = False
            over = any(m in line for m in ended) if last is None or us >= last else over
            last = us if last is None else max(last, us)
        return (last, stalled, over), log, None if stalled or over else last + span

    return stateful(lines, ["run_id"], ["ts", "seq", "line"], ["ts", "seq"], step, "us long, alarm string, last_us long",
                    "last long, stalled boolean, over boolean", event_time="ts")
