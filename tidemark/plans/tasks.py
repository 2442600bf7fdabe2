"""The daily tasks: an ordered registry with its dependencies, a ledger row for each run, one run at a time."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from tidemark.operators.store import Store
from tidemark.plans.lease import SECONDS, Fenced, Lease
from tidemark.schema import TABLES
from tidemark.sources.client import redact

#: Tasks in order; (name, attempts, optional).
DAILY = (("ingest_prices", 3, False), ("ingest_news", 3, False), ("build_prices", 1, False), ("build_news", 1, False), ("build_features", 1, False), ("refresh_news_recent", 1, False), ("fit_models", 1, False), ("sync_news_index", 1, False), ("sync_history", 1, False), ("backfill_news_recent", 1, True))
ERROR_CHARS = 1000
log = logging.getLogger(__name__)


def cut_error(text: str) -> str:
    return text if len(text) <= ERROR_CHARS else text[:ERROR_CHARS - 3] + "..."


@dataclass
class Run:
    task: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    started_at: datetime = field(default_factory=lambda: datetime.now(UTC))
    rows_written: int = 0


@contextmanager
def ledger(store: Store, task: str):
    """One row for a run whether it ends well or not; a ledger that fails is reported and no more."""
    run, error = Run(task), None
    try:
        yield run
    except Exception as e:
        error = cut_error(redact(f"{type(e).__name__}: {e}"))
        raise
    finally:
        table = TABLES["bronze.ingestion_runs"]
        row = (run.run_id, task, run.started_at, datetime.now(UTC), "failed" if error else "succeeded", run.rows_written, error)
        try:
            store.upsert(table, store.spark.createDataFrame([row], table.schema))
        except Exception as e:  # the run's own outcome counts
            log.warning("ledger of %s: %s", task, cut_error(redact(str(e))))


Task = Callable[[SparkSession, dict], int]


def run_task(name: str, tasks: dict[str, Task], spark: SparkSession, conf: dict, store: Store) -> int:
    attempts = {n: a for n, a, _ in DAILY}
    if name not in attempts or name not in tasks:
        raise KeyError(f"no task {name}")
    for k in range(attempts[name]):
        try:
            with ledger(store, name) as run:
                run.rows_written = tasks[name](spark, conf)
                return run.rows_written
        except Fenced:
            raise  # another run goes on
        except Exception:
            if k + 1 == attempts[name]:
                raise
    return 0


def run_daily(tasks: dict[str, Task], spark: SparkSession, conf: dict, store: Store, with_optional: bool = False, seconds: float = SECONDS) -> dict[str, int]:
    """All tasks in order, under the lease; a task that fails stops those after it, an optional one doesn't."""
    done: dict[str, int] = {}
    with Lease(store, "daily", seconds).held():
        for name, _, optional in DAILY:
            if optional and not with_optional:
                continue
            try:
                done[name] = run_task(name, tasks, spark, conf, store)
            except Fenced:
                raise
            except Exception:
                if not optional:
                    raise
                log.exception("optional task %s failed", name)
    return done


def write_gold(store: Store, frames: dict[str, object]) -> int:
    """All frames are checked before any is written."""
    checked = {name: TABLES[name].check(df) for name, df in frames.items()}
    return sum(store.upsert(TABLES[name], df) for name, df in checked.items())


class Telemetry:
    """Calls held on the driver (at most ``most``; the oldest go, counted and logged), written in one
    batch; a failed flush keeps them."""

    def __init__(self, store: Store, most: int = 1000) -> None:
        self.store, self.most, self.rows, self.dropped = store, most, [], 0

    def _hold(self, rows: list[dict]) -> None:
        over = max(0, len(rows) - self.most)
        if over:
            self.dropped += over
            log.warning("telemetry holds %d calls at most: %d dropped so far", self.most, self.dropped)
        self.rows = rows[over:]

    def record(self, **call) -> None:
        self._hold([*self.rows, {"call_id": uuid.uuid4().hex} | call])

    def flush(self) -> int:
        table, held = TABLES["gold.model_calls"], self.rows
        self.rows = []
        try:
            names = table.schema.fieldNames()
            return self.store.upsert(table, self.store.spark.createDataFrame([tuple(r.get(c) for c in names) for r in held], table.schema)) if held else 0
        except Exception:
            self._hold(held + self.rows)
            raise
