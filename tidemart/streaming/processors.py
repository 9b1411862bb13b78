"""Keyed-state processors for ``transformWithStateInPandas``.

Rows of a key arrive in chunks of bounded size and in no order. What must wait lies in the state
store on disk; what a processor holds in memory stands with it. Visitors are dealt to buckets: a call
and its trips to the state store serve many visitors.
"""

from __future__ import annotations

import json
from itertools import islice

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CHUNK = 5000
#: Stands for no part: no row of the visitor needs its first-visit date.
NO_PART = -1
#: Rows that wait for their successor are kept by day: a trip to the state store takes about 1 ms.
DAY_MS = 24 * 60 * 60 * 1000


class FirstVisitDay(StatefulProcessor):
    """State: the first-visit date of each visitor of a bucket, set once.

    Rows are one for each chunk of input and part of a visitor's rows in it, with the chunk's first
    record. Each part gets the date, once per micro-batch. In memory are the visitors and parts that a
    bucket has in a micro-batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getMapState("first_visit", "mid string", "day string")

    def handleInputRows(self, key, rows, timerValues):
        firsts = parts = None
        for chunk in rows:
            both = chunk if firsts is None else pd.concat([firsts, chunk])
            firsts = both.sort_values(["ts", "seq"]).drop_duplicates("mid")
            told = chunk.loc[chunk["part"] != NO_PART, ["mid", "part"]]
            parts = (told if parts is None else pd.concat([parts, told])).drop_duplicates()
        days = {}
        for mid, day in zip(firsts["mid"], firsts["first_day"]):
            # A map has no null key.
            name = ("-" if mid is None else "+" + mid,)
            known = self._first.getValue(name)
            if known is None:
                self._first.updateValue(name, (day,))
            days[mid] = day if known is None else known[0]
        given = pd.DataFrame({"mid": parts["mid"], "part": parts["part"].astype("int32")})
        given["first_day"] = pd.Series([days[m] for m in given["mid"]], index=given.index, dtype=object)
        yield given

    def close(self) -> None:
        pass


class FirstVisitMark(StatefulProcessor):
    """Marks the rows of a bucket of (visitor, part) by the first-visit date, as told for the part.

    The row that tells it comes in the same micro-batch as the part's rows, in no order. Of the rows
    before it one chunk waits in memory, the others in list state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._waiting = handle.getListState("waiting", "mid string, day string, payload string")

    @staticmethod
    def _marked(mids, days, payloads, told):
        marks = ["1" if d == told[m] else "0" for m, d in zip(mids, days)]
        return pd.DataFrame({"is_new": marks, "payload": payloads}, dtype=object)

    def handleInputRows(self, key, rows, timerValues):
        told, held, stored = {}, [], False
        for chunk in rows:
            tells = chunk["payload"].isna()
            told.update(zip(chunk.loc[tells, "mid"], chunk.loc[tells, "first_day"]))
            fresh = list(chunk.loc[~tells, ["mid", "day", "payload"]].itertuples(index=False, name=None))
            ready = [r for r in fresh if r[0] in told]
            if ready:
                yield self._marked(*zip(*ready), told)
            held += [r for r in fresh if r[0] not in told]
            if len(held) > CHUNK:
                self._waiting.appendList(held)
                held, stored = [], True
        if held:
            yield self._marked(*zip(*held), told)
        if stored:
            waiting = self._waiting.get()
            while part := list(islice(waiting, CHUNK)):
                yield self._marked(*zip(*part), told)
            self._waiting.clear()
        yield pd.DataFrame({"is_new": [], "payload": []}, dtype=object)

    def close(self) -> None:
        pass


class DailyFirst(StatefulProcessor):
    """State: the last date a visitor was seen, dropped ``ttl_ms`` of event time after it was set.

    Gives a row when its date differs from the state. Per chunk only the first row of a date is
    kept, so memory grows with the number of dates in a micro-batch, not with its rows.
    """

    def __init__(self, ttl_ms: int):
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last_visit", "day string, expires long")

    def handleInputRows(self, key, rows, timerValues):
        firsts = None
        for chunk in rows:
            both = chunk if firsts is None else pd.concat([firsts, chunk])
            firsts = both.sort_values(["ts", "seq"]).drop_duplicates("day")
        state = self._last.get()
        last = state[0] if state is not None else None
        keep = []
        for day in firsts["day"]:
            keep.append(day != last)
            last = day
        given = firsts[keep]
        if len(given):
            # A late row's date is kept as long as any other.
            now = max(int(given["ts"].iloc[-1]), timerValues.getCurrentWatermarkInMs())
            self._last.update((last, now + self._ttl_ms))
            self._handle.registerTimer(now + self._ttl_ms)
        yield given[["payload"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state = self._last.get()
        if state is not None and state[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self._last.clear()
        yield pd.DataFrame({"payload": []}, dtype=object)

    def close(self) -> None:
        pass


class JumpDetector(StatefulProcessor):
    """State: the rows of a bucket of (visitor, time slice) that wait for their successor, by the day
    of their slice.

    A row is decided when the watermark is past the end of its second plus the timeout; then every row
    that could follow it in time has come. A timer stands for the oldest second that waits and decides
    all that the watermark has passed. In memory are the rows of a bucket and day.
    """

    def __init__(self, timeout_ms: int):
        self._timeout = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # By day: how many parts there are, and the oldest second in them.
        self._days = handle.getValueState("days", "days string")
        self._rows = handle.getMapState("rows", "day long, part long", "rows string")

    def _known(self) -> dict[int, list[int]]:
        state = self._days.get()
        return {} if state is None else {int(h): v for h, v in json.loads(state[0]).items()}

    def _keep(self, days: dict[int, list[int]], timer: int | None) -> None:
        """Store what is known of the days, and wake up for the oldest second if ``timer`` is later."""
        if not days:
            self._days.clear()
            return
        self._days.update((json.dumps(days),))
        wake = self._due(days)
        if timer is None or wake < timer:
            self._handle.registerTimer(wake)

    def _due(self, days: dict[int, list[int]]) -> int:
        return (min(second for _, second in days.values()) + 1) * 1000 + self._timeout

    def _put(self, days: dict[int, list[int]], day: int, rows: pd.DataFrame) -> None:
        parts, oldest = days.get(day, (0, None))
        second = int(rows["ts"].min()) // 1000
        columns = {c: rows[c].tolist() for c in ("name", "ts", "seq", "is_start", "payload")}
        self._rows.updateValue((day, parts), (json.dumps(columns),))
        days[day] = [parts + 1, second if oldest is None else min(oldest, second)]

    def handleInputRows(self, key, rows, timerValues):
        days = self._known()
        timer = self._due(days) if days else None
        for chunk in rows:
            for day, group in chunk.groupby(chunk["slice"] // DAY_MS):
                self._put(days, int(day), group)
        self._keep(days, timer)
        yield pd.DataFrame({"reason": [], "payload": []}, dtype=object)

    def _decided(self, held: pd.DataFrame, edge: int) -> pd.DataFrame:
        """The jumps among the rows before ``edge``."""
        held["name"] = pd.factorize(held["name"])[0]
        held = held.sort_values(["name", "ts", "seq"])
        follower = held.shift(-1)
        near = (follower["name"] == held["name"]) & (follower["ts"] - held["ts"] < self._timeout)
        jumps = held["payload"].notna() & held["is_start"].astype(bool) & (held["ts"] < edge)
        jumps &= ~near | follower["is_start"].eq(True)
        reasons = near[jumps].map({True: "match", False: "timeout"})
        return pd.DataFrame({"reason": reasons, "payload": held.loc[jumps, "payload"]}, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        edge = (now - self._timeout) // 1000 * 1000
        days = self._known()
        due = sorted(h for h, (_, second) in days.items() if second * 1000 < edge)
        for day in due:
            parts, _ = days.pop(day)
            texts = [self._rows.getValue((day, part))[0] for part in range(parts)]
            held = pd.concat([pd.DataFrame(json.loads(t)) for t in texts], ignore_index=True)
            for part in range(parts):
                self._rows.removeKey((day, part))
            left = held[held["ts"] >= edge]
            if len(left):
                self._put(days, day, left)
            yield self._decided(held, edge)
        if due:
            self._keep(days, None)
        yield pd.DataFrame({"reason": [], "payload": []}, dtype=object)

    def close(self) -> None:
        pass


class OuterJoin(StatefulProcessor):
    """State: the rows of both sides of one join key that can still meet others, by side and id.

    A row that a preserved side has no partner for is given at once, with the other side empty. When
    a partner comes, that row is taken back and the pair is given. Within a micro-batch only the
    outcome is given, so an output row is named once at most. In memory are the rows of one join key.
    Keys have few rows, so it works on rows: a data frame for each key takes longer than the join.
    """

    def __init__(self, keep_left: bool, keep_right: bool, within_ms: int | None):
        self._keep = {True: keep_left, False: keep_right}
        self._within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getMapState(
            "rows", "is_left boolean, id string", "ts long, payload string, met boolean"
        )

    def _near(self, a: int, b: int) -> bool:
        return self._within is None or abs(a - b) <= self._within

    def handleInputRows(self, key, rows, timerValues):
        held = {tuple(k): list(v) for k, v in self._rows.iterator()}
        fresh = {}
        for row in rows:
            fresh[row.is_left, row.id] = [row.ts, row.payload, False]
        known = {True: {}, False: {}}
        for (is_left, row_id), row in {**held, **fresh}.items():
            known[is_left][row_id] = row
        pairs, met = [], set()
        for is_left, row_id in fresh:
            row = known[is_left][row_id]
            for other_id, other in known[not is_left].items():
                # A pair of two fresh rows is found from its left one.
                if (is_left or (True, other_id) not in fresh) and self._near(row[0], other[0]):
                    pairs.append((row[1], other[1]) if is_left else (other[1], row[1]))
                    met |= {(is_left, row_id), (not is_left, other_id)}
        alone, back = [], []
        for name, row in {**held, **fresh}.items():
            before = held[name][2] if name in held else None
            if name in met and before is False and self._keep[name[0]]:
                back.append((name[0], row[1]))
            if name not in met and name in fresh and not before and self._keep[name[0]]:
                alone.append((name[0], row[1]))
            now = name in met or bool(before)
            if name in fresh or now != before:
                self._rows.updateValue(name, (row[0], row[1], now))
            if name in fresh and self._within is not None:
                self._handle.registerTimer(row[0] + self._within + 1)
        for left, right in pairs:
            yield Row(left=left, right=right, removed=False)
        for given, removed in ((alone, False), (back, True)):
            for is_left, p in given:
                yield Row(left=p if is_left else None, right=None if is_left else p, removed=removed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """No row that can still come is near enough to these."""
        now = expiredTimerInfo.getExpiryTimeInMs()
        gone = [tuple(k) for k, v in self._rows.iterator() if v[0] + self._within < now]
        for name in gone:
            self._rows.removeKey(name)
        return iter(())

    def close(self) -> None:
        pass
