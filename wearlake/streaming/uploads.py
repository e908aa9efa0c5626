"""Chunk uploads as a state per chunk: attempts, waits of 2, 4 and 8 seconds after errors, and an end that stays.

Records (session_id, chunk_index, kind, attempt, at): ``queued`` starts a chunk, ``ok`` and ``error`` tell how an attempt
went.  Transitions (session_id, chunk_index, attempt, status, at) come out: ``uploading`` asks for an attempt, ``done``
and ``failed`` end the chunk for good.  Waits are timers of the state, so a chunk that waits holds up nothing else, and
all times are the records', so a replay of the stream gives what its first run gave, however it is cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from wearlake.streaming.ingest import DONE, FAILED, UPLOADING, WAITS

RECORD = "session_id string, chunk_index int, kind string, attempt int, at timestamp"
_OUT = "session_id string, chunk_index int, attempt int, status string, at timestamp"
#: Waiting for the next attempt, after an error.
_WAITING = "waiting"
_END = 1 << 62


class Upload:
    """One chunk: status, the number of its attempt, and when its timer rings (milliseconds)."""

    def __init__(self, status: str | None = None, attempt: int = 0, due: int = _END, waits=WAITS, patience: float = 60.0, keep: float = 86400.0):
        self.status, self.attempt, self.due = status, attempt, due
        self.waits, self.patience, self.keep = [round(1000 * w) for w in waits], round(1000 * patience), round(1000 * keep)
        self.made: list[tuple[int, str, int]] = []

    def _tell(self, status: str, at: int, due: int) -> None:
        self.status, self.due = status, due
        self.made.append((self.attempt, status, at))

    def _try(self, at: int) -> None:
        self.attempt += 1
        self._tell(UPLOADING, at, at + self.patience)

    def _error(self, at: int) -> None:
        self.status, self.due = _WAITING, at + self.waits[self.attempt - 1]

    def ring(self, until: int) -> bool:
        """Let timers up to a time ring; whether the chunk's time is over and its state may go."""
        while self.due <= until:
            if self.status == UPLOADING:
                self._error(self.due)  # nothing heard of the attempt
            elif self.status == _WAITING and self.attempt < len(self.waits):
                self._try(self.due)
            elif self.status == _WAITING:
                self._tell(FAILED, self.due, self.due + self.keep)
            else:
                return True
        return False

    def hear(self, kind: str, attempt: int | None, at: int) -> None:
        """A record in the order of time; what doesn't concern the attempt under way changes nothing."""
        if self.ring(at):
            self.status, self.attempt, self.due = None, 0, _END  # forgotten: a new chunk
        if kind == "queued" and self.status is None:
            self._try(at)
        elif self.status == UPLOADING and attempt == self.attempt:
            if kind == "ok":
                self._tell(DONE, at, at + self.keep)
            elif kind == "error":
                self._error(at)


def _millis(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[ms]").astype("int64")


def _ordered(p: pd.DataFrame) -> Iterator[tuple]:
    """Records by time; at one time a queueing first, an attempt's success before its error."""
    p = p.assign(_at=_millis(p["at"]), _kind=p["kind"].map({"queued": 0, "ok": 1, "error": 2}).fillna(3), _n=p["attempt"].fillna(0))
    p = p.sort_values(["_at", "_kind", "_n"], kind="stable")
    return zip(p["kind"], p["_n"].astype(int), p["_at"])


def _frame(key: tuple, made: list[tuple[int, str, int]]) -> pd.DataFrame:
    out = pd.DataFrame(made, columns=["attempt", "status", "at"])
    out["at"] = pd.to_datetime(out["at"], unit="ms")
    out.insert(0, "session_id", key[0])
    out.insert(1, "chunk_index", key[1])
    return out.astype({"session_id": object, "chunk_index": "int32", "attempt": "int32"})


def uploads(
    records: DataFrame, waits: tuple[float, ...] = WAITS, late: str = "10 seconds", patience: float = 60.0, keep: float = 86400.0
) -> DataFrame:
    """Transitions of a stream of records.  Timers ring as the watermark, ``late`` behind the newest record, passes them.

    An attempt of which nothing is heard for ``patience`` seconds counts as an error.  An ended chunk is known for
    ``keep`` seconds, so that one sent again isn't taken up again; then its state goes.  Records without a session,
    chunk, time or known kind change nothing.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = state.get if state.exists else (None, 0, _END)
        chunk = Upload(*known, waits=waits, patience=patience, keep=keep)
        for kind, attempt, at in [] if state.hasTimedOut else _ordered(pd.concat(parts)):
            chunk.hear(kind, attempt, at)
        mark = state.getCurrentWatermarkMs()
        if chunk.ring(mark) or chunk.status is None:
            if state.exists:
                state.remove()
        else:
            state.update((chunk.status, chunk.attempt, chunk.due))
            state.setTimeoutTimestamp(max(chunk.due, mark + 1))
        yield _frame(key, chunk.made)

    whole = records.filter("session_id is not null and chunk_index is not null and at is not null")
    return whole.withWatermark("at", late).groupBy("session_id", "chunk_index").applyInPandasWithState(
        run, _OUT, "status string, attempt int, due long", "append", "EventTimeTimeout"
    )


def settled(records: DataFrame, waits: tuple[float, ...] = WAITS, patience: float = 60.0, keep: float = 86400.0) -> DataFrame:
    """The transitions of a recorded stream, after all its timers have rung.

    Records are sorted in partitions by chunk and time, and one chunk's state is carried along at a time.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, chunk, made = None, None, []

        def take() -> None:
            made.extend((*key, *m) for m in chunk.made)
            chunk.made.clear()

        for p in parts:
            for *own, kind, attempt, at in p.itertuples(index=False, name=None):
                if own != key:
                    if chunk is not None:
                        chunk.ring(_END - 1)
                        take()
                    key, chunk = own, Upload(waits=waits, patience=patience, keep=keep)
                chunk.hear(kind, attempt, at)
                take()
            yield pd.DataFrame(made, columns=["session_id", "chunk_index", "attempt", "status", "ms"])
            made.clear()
        if chunk is not None:
            chunk.ring(_END - 1)
            take()
            yield pd.DataFrame(made, columns=["session_id", "chunk_index", "attempt", "status", "ms"])

    key = ["session_id", "chunk_index"]
    whole = records.filter("session_id is not null and chunk_index is not null and at is not null")
    order = F.when(F.col("kind") == "queued", 0).when(F.col("kind") == "ok", 1).when(F.col("kind") == "error", 2).otherwise(3)
    rows = whole.select(*key, F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("attempt", F.lit(0)).alias("attempt"), F.unix_millis("at").alias("ms"), order.alias("_kind"))
    dealt = rows.repartition(*key).sortWithinPartitions(*key, "ms", "_kind", "attempt").drop("_kind")
    told = dealt.mapInPandas(run, "session_id string, chunk_index int, attempt int, status string, ms long")
    return told.select(*key, "attempt", "status", F.timestamp_millis("ms").alias("at"))


def latest_status(transitions: DataFrame) -> DataFrame:
    """Each chunk's last transition: its status, attempts and time."""
    last = F.max_by(F.struct("status", "attempt", "at"), F.struct("at", "attempt", F.col("status") != UPLOADING)).alias("last")
    return transitions.groupBy("session_id", "chunk_index").agg(last).select("session_id", "chunk_index", "last.status", "last.attempt", "last.at")
