"""Token buckets by caller: as a stream with timers, and over tables as a scan.

Tokens are whole numbers of ``unit``: a token has ``unit`` of them and every microsecond
adds ``rate``, so results do not depend on how the events are dealt.

Over a table the events are range-partitioned by caller and time. What a stretch of a
caller's events does to the tokens that it finds is a function of few pieces: it adds
what was refilled, takes off whole tokens, and never passes the capacity. Only the first
stretch of a partition can have begun in another one; the functions of these, one a
partition, are put together in order and give each partition its start. So a caller of
any number of events is spread over as many tasks as they need.
"""

from __future__ import annotations

from bisect import bisect_right
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

_OUT = "event_id long, user_id long, refused boolean, wait double"


class Policy:
    """Capacity in tokens and refill a minute, as whole numbers."""

    def __init__(self, capacity: int, per_minute: float):
        share = Fraction(per_minute).limit_denominator(1000) / 60_000_000
        if capacity < 1 or share <= 0:
            raise ValueError("a bucket needs room for a token, and a refill")
        self.unit, self.rate = share.denominator, share.numerator
        self.full = capacity * self.unit

    def refilled(self, left: int, micros: int) -> int:
        return min(self.full, left + max(0, micros) * self.rate)

    def run(self, times: list[int], left: int) -> tuple[list[int], int]:
        """Tokens found by each event, and what is left after the last; ``left``: at the first event."""
        found, before = [], times[0] if times else 0
        for t in times:
            left = self.refilled(left, t - before)
            before = t
            found.append(left)
            if left >= self.unit:
                left -= self.unit
        return found, left

    def function(self, times: list[int]) -> list[tuple[int, int, bool]]:
        """What the events make of the tokens x found by the first: pieces (from, value,
        fixed): from that x on, ``value`` if fixed, else x + ``value``."""
        pieces, before = [(0, 0, False)], times[0] if times else 0
        for t in times:
            added, before, made = (t - before) * self.rate, t, []
            for k, (start, value, fixed) in enumerate(pieces):
                stop = pieces[k + 1][0] if k + 1 < len(pieces) else self.full + 1
                if fixed:
                    y = min(self.full, value + added)
                    made.append((start, y - self.unit if y >= self.unit else y, True))
                    continue
                shift = value + added
                for a, b, served in ((start, self.unit - shift, False), (max(start, self.unit - shift), self.full - shift, True)):
                    if a < min(b, stop):
                        made.append((a, shift - self.unit if served else shift, False))
                a = max(start, self.full - shift)
                if a < stop:
                    made.append((a, self.full - self.unit, True))
            pieces = [p for k, p in enumerate(made) if not k or p[1:] != made[k - 1][1:]]
        return pieces

    @staticmethod
    def value(pieces: list[tuple[int, int, bool]], x: int) -> int:
        _, value, fixed = pieces[bisect_right([p[0] for p in pieces], x) - 1]
        return value if fixed else x + value


def _stretches(users: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(users[1:] != users[:-1]) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(users)], strict=True)) if len(users) else []


def token_bucket(events: DataFrame, capacity: int = 5, per_minute: float = 10.0, partitions: int | None = None) -> DataFrame:
    """event_id, user_id, refused and wait (seconds until a token is there) of every event.

    A caller starts with a full bucket; events of a caller count in order of ts, then
    event_id; repeated rows count each. Events without a user or a time are passed over;
    other columns are ignored.
    """
    policy = Policy(capacity, per_minute)
    n = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    dealt = written(rows.repartitionByRange(n, "user_id", "at", "event_id").withColumn("part", F.spark_partition_id()), "calls")

    def ends(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["user_id", "at", "event_id"])
        users, at = pdf["user_id"].to_numpy(), pdf["at"].tolist()
        cuts = _stretches(users)
        a, b = cuts[0]
        pieces = policy.function(at[a:b])
        last, z = cuts[-1]
        left = policy.run(at[last:z], policy.full)[1] if len(cuts) > 1 else 0
        row = (int(key[0]), int(users[0]), at[a], at[b - 1], int(users[-1]), at[z - 1], left, len(cuts) == 1, *(list(x) for x in zip(*pieces, strict=True)))
        return pd.DataFrame([row], columns=["part", "user", "first_at", "last_at", "last_user", "end_at", "end_left", "single", "starts", "values", "fixed"])

    found = dealt.groupBy("part").applyInPandas(ends, "part int, user long, first_at long, last_at long, last_user long, end_at long, end_left long, single boolean, starts array<long>, values array<long>, fixed array<boolean>")
    begin, carried = [], None
    for r in sorted(found.collect(), key=lambda r: r["part"]):  # one row a partition, of a few pieces
        x = policy.full
        if carried and carried[0] == r["user"]:
            x = policy.refilled(carried[2], r["first_at"] - carried[1])
        begin.append((r["part"], x))
        if r["single"]:
            carried = r["user"], r["last_at"], policy.value(list(zip(r["starts"], r["values"], r["fixed"], strict=True)), x)
        else:
            carried = r["last_user"], r["end_at"], r["end_left"]
    starts = events.sparkSession.createDataFrame(begin, "part int, start long")

    def run(key, pdf):
        pdf = pdf.sort_values(["user_id", "at", "event_id"])
        at, tokens = pdf["at"].tolist(), []
        for k, (a, b) in enumerate(_stretches(pdf["user_id"].to_numpy())):
            tokens += policy.run(at[a:b], int(pdf["start"].iloc[0]) if not k else policy.full)[0]
        short = [max(0, policy.unit - x) for x in tokens]
        return pdf.assign(refused=[s > 0 for s in short], wait=[s / policy.rate / 1e6 for s in short])[["event_id", "user_id", "refused", "wait"]]

    return dealt.join(F.broadcast(starts), "part").groupBy("part").applyInPandas(run, _OUT)


def token_bucket_stream(stream: DataFrame, capacity: int = 5, per_minute: float = 10.0, late: str = "10 minutes") -> DataFrame:
    """The same for a stream of events: the tokens of a caller are state, which a timer
    drops when the bucket is full again (a caller without state has a full bucket). An
    event before its caller's last one counts at the time of that one."""
    from pyspark.sql.streaming import StatefulProcessor

    policy = Policy(capacity, per_minute)

    class Calls(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.tokens = handle.getValueState("tokens", "left long, at long")

        def handleInputRows(self, key, batches, timers):
            import pandas as pd

            pdf = pd.concat(list(batches)).sort_values(["ts", "event_id"])
            at = (pdf["ts"].astype("datetime64[us]").astype("int64")).tolist()
            left, before = (int(x) for x in self.tokens.get()) if self.tokens.exists() else (policy.full, at[0])
            at = np.maximum.accumulate([before, *at])[1:].tolist()
            found, left = policy.run(at, policy.refilled(left, at[0] - before))
            self.tokens.update((left, at[-1]))
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer((at[-1] + -(-(policy.full - left) // policy.rate)) // 1000 + 1)
            short = [max(0, policy.unit - x) for x in found]
            yield pd.DataFrame({"event_id": pdf["event_id"].to_numpy(), "user_id": key[0], "refused": [s > 0 for s in short], "wait": [s / policy.rate / 1e6 for s in short]})

        def handleExpiredTimer(self, key, timers, expired):
            import pandas as pd

            self.tokens.clear()
            yield pd.DataFrame({"event_id": pd.Series([], dtype="int64"), "user_id": pd.Series([], dtype="int64"), "refused": pd.Series([], dtype=bool), "wait": pd.Series([], dtype=float)})

        def close(self):
            pass

    rows = stream.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), "ts")
    return rows.withWatermark("ts", late).groupBy("user_id").transformWithStateInPandas(Calls(), outputStructType=_OUT, outputMode="append", timeMode="eventTime")
