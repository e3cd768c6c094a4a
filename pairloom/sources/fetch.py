"""Fetching (S11, P8, F9): many requests at once within each task, each of which ends.

A host's addresses are dealt to ``SPREAD`` parts, of which at most ``rate / SPREAD`` are started a
second each, in one task or several; so a host is never asked faster than its rate, and one with a third of all
addresses isn't one task.  Within a task parts take turns: one that must wait holds no other up.

A request that has not ended at its deadline is that row's failure, whatever its fetcher does; its
thread is left to itself and another takes its place.  A fetcher is given the seconds that it has
for a connection and in all, and should keep to them.
"""

from __future__ import annotations

import heapq
import itertools
import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.image import status
from ..functions.url import host

CONNECTIONS = 64
#: Seconds for a connection, and for all of a request.
CONNECT, TOTAL = 10.0, 20.0
#: Requests a second to one host, and tasks that share its addresses.
RATE, SPREAD = 20.0, 4
#: Requests that a task holds: rows waiting for their host's turn, at most.
HELD = 2000
ERROR, TIMEOUT = "error", "timeout"
SCHEMA = "sample_id long, url string, text string, license string, language string, n_bytes long, width int, height int, format string, failed boolean, fault string"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
ARROW = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in SCHEMA.split(", "))])

Fetcher = Callable[[str, float, float], dict]


def ended(rows: Iterator[dict], get: Fetcher, connections: int, connect: float, total: float, rate: float) -> Iterator[dict]:
    """Each row (with ``host`` and ``url``) and what ``get`` tells of its address, as they end."""
    done: queue.SimpleQueue = queue.SimpleQueue()
    waiting: dict[str, deque] = {}
    turns: list[tuple[float, str]] = []  # when a host that has rows may be asked
    free_at: dict[str, float] = {}
    running: dict[int, tuple[dict, float]] = {}
    held = number = 0
    more = True

    def work(n: int, row: dict) -> None:
        try:
            got = {**row, "failed": False, **get(row["url"], connect, total)}
        except Exception:  # the row's status says so
            got = {**row, "failed": True, "fault": ERROR}
        done.put((n, got))

    while more or held or running:
        while more and held < HELD:
            row = next(rows, None)
            if row is None:
                more = False
                break
            at = row["host"] or ""
            if not waiting.setdefault(at, deque()):
                heapq.heappush(turns, (free_at.get(at, 0.0), at))
            waiting[at].append(row)
            held += 1
        now = time.monotonic()
        while turns and turns[0][0] <= now and len(running) < connections:
            _, at = heapq.heappop(turns)
            row = waiting[at].popleft()
            held, number = held - 1, number + 1
            free_at[at] = now + 1 / rate
            if waiting[at]:
                heapq.heappush(turns, (free_at[at], at))
            else:
                del waiting[at]
            running[number] = (row, now + total)
            threading.Thread(target=work, args=(number, row), daemon=True).start()
        if len(free_at) > 10 * HELD:
            free_at = {k: t for k, t in free_at.items() if t > now}
        until = [deadline for _, deadline in itertools.islice(running.values(), 1)]  # the first began first
        if turns and len(running) < connections:
            until.append(turns[0][0])
        if until:
            try:
                n, got = done.get(timeout=max(0.001, min(until) - time.monotonic()))
                if running.pop(n, None):  # else it ended behind its deadline
                    yield got
            except queue.Empty:
                pass
        now = time.monotonic()
        for n in [n for n, _ in itertools.takewhile(lambda x: x[1][1] <= now, running.items())]:
            yield {**running.pop(n)[0], "failed": True, "fault": TIMEOUT}


def fetched(requests: DataFrame, fetcher: Callable[[], Fetcher], connections: int = CONNECTIONS, connect: float = CONNECT, total: float = TOTAL, rate: float = RATE, spread: int = SPREAD) -> DataFrame:
    """Requests (sample_id, url, text, license, language) with what an injected fetcher
    tells of each address: url (after redirects), n_bytes, width, height, format; the fault (an error or a timeout), and
    the status."""

    def run(batches):
        get = fetcher()
        rows = (row for b in batches for i in range(0, b.num_rows, 1000) for row in b.slice(i, 1000).to_pylist())
        out = []
        for got in ended(rows, get, connections, connect, total, rate / spread):
            out.append({k: got.get(k) for k in ARROW.names})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=ARROW)

    part = F.concat(F.coalesce(host("url"), F.lit("")), F.lit(" "), F.pmod(F.xxhash64("url"), F.lit(spread)).cast("string"))
    slim = requests.select("sample_id", "url", "text", "license", "language", part.alias("host"))
    # As many tasks as said: their time is that of waiting, not of their few bytes, by which they would be merged.
    dealt = slim.repartition(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), "host")
    got = dealt.mapInArrow(run, SCHEMA)
    return got.withColumn("status", status(F.coalesce("n_bytes", F.lit(5000)), "width", "height", "format", "failed"))
