"""Runs of the whole pipeline: phases of stages, their status, retries and cancellation.

One driver process replaces scripts that start scripts: a stage is a function of the
pipeline's state, its Spark jobs share a job group so that they can be cancelled, and
every change of status is recorded and rolled up to phase and run.
"""

from __future__ import annotations

import json
import posixpath
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import TextIO

from pyspark.sql import SparkSession

from estatescope import workspace

Stage = Callable[[dict], None]
TERMINAL = ("finished", "error", "cancelled", "failed")


class Cancelled(Exception):
    """A run was told to stop."""


def roll_up(children: list[str], own: str) -> str:
    """Status from the children's; without children it stays, and cancelled stays cancelled."""
    if own == "cancelled" or not children:
        return own
    for s in ("running", "error", "cancelled"):
        if s in children:
            return s
    return "finished" if all(c == "finished" for c in children) else "failed"


@dataclass
class Entry:
    """Status of a run, a phase or a stage."""

    name: str
    status: str = "pending"
    started_at: datetime | None = None
    finished_at: datetime | None = None
    error_message: str | None = None
    logs: list[str] = field(default_factory=list)
    children: list[Entry] = field(default_factory=list)

    def mark(self, status: str, error: str | None = None) -> None:
        now = datetime.now(timezone.utc)
        self.started_at = self.started_at or (now if status == "running" else None)
        self.finished_at = now if status in TERMINAL else None
        if self.status != "cancelled" or status == "cancelled":
            self.status = status
        self.error_message = error or self.error_message

    def as_dict(self) -> dict:
        """Nested view of the status, times in ISO form and logs as one text."""
        iso = lambda t: t.isoformat() if t else None
        return {
            "name": self.name, "status": self.status, "started_at": iso(self.started_at), "finished_at": iso(self.finished_at),
            "error_message": self.error_message, "logs": "\n".join(self.logs), "children": [c.as_dict() for c in self.children],
        }

    @staticmethod
    def of(d: dict) -> Entry:
        """Entry of a nested view."""
        time_of = lambda t: datetime.fromisoformat(t) if t else None
        return Entry(
            d["name"], d["status"], time_of(d["started_at"]), time_of(d["finished_at"]), d["error_message"],
            d["logs"].split("\n") if d["logs"] else [], [Entry.of(c) for c in d["children"]],
        )


class Tee:
    """A text stream that writes to several at once, for ``contextlib.redirect_stdout``."""

    def __init__(self, *streams: TextIO):
        self.streams = streams

    def write(self, text: str) -> int:
        for s in self.streams:
            s.write(text)
        return len(text)

    def flush(self) -> None:
        for s in self.streams:
            s.flush()


@dataclass
class Answer:
    """Result of a control call: an HTTP-like code and a body."""

    code: int
    body: dict


class Pipeline:
    """Control of runs.

    phases: number to (name, stages by name); attempts and delay: tries of a stage and
    seconds between them; store: folder where every change of a run's status is kept, one file per run, and read
    from at the start. A run found under way was left by a driver that ended: the next start cancels it.
    """

    def __init__(
        self, spark: SparkSession, phases: dict[int, tuple[str, dict[str, Stage]]], attempts: int = 5, delay: float = 60.0, store: str | None = None
    ):
        self.spark, self.phases, self.attempts, self.delay, self.store = spark, phases, attempts, delay, store
        kept = workspace.read_texts(spark, store, ".json") if store else {}
        self.runs: dict[int, Entry] = {int(n.split(".")[0]): Entry.of(json.loads(t)) for n, t in sorted(kept.items())}
        self._lock = threading.Lock()
        self.state: dict = {"spark": spark, "base": "/data"}
        self._stop: set[int] = set()
        self._threads: dict[int, threading.Thread] = {}

    def _save(self, run_id: int) -> None:
        if self.store:
            with self._lock:
                workspace.write_text(self.spark, f"{self.store}/{run_id:09d}.json", json.dumps(self.runs[run_id].as_dict()))

    def _begin(self, numbers: list[int]) -> Answer:
        stale = [i for i, r in self.runs.items() if r.status == "running"]
        if stale:
            for i in stale:
                self.stop(i)
            return Answer(400, {"error": "a run was under way and has been cancelled"})
        run_id = max(self.runs, default=0) + 1
        run = Entry(f"run {run_id}")
        run.children = [Entry(self.phases[n][0], children=[Entry(s) for s in self.phases[n][1]]) for n in numbers]
        run.mark("running")
        self.runs[run_id] = run
        self._save(run_id)
        thread = threading.Thread(target=self._work, args=(run_id, numbers), daemon=True)
        self._threads[run_id] = thread
        thread.start()
        return Answer(200, {"run_id": run_id})

    def start(self) -> Answer:
        """Run all phases in order; a run under way is cancelled instead and the call refused."""
        return self._begin(sorted(self.phases))

    def run_phase(self, number: int) -> Answer:
        """Run one phase."""
        return self._begin([number]) if number in self.phases else Answer(404, {"error": "no such phase"})

    def status(self, run_id: int) -> Answer:
        run = self.runs.get(run_id)
        return Answer(200, run.as_dict()) if run else Answer(404, {"error": "no such run"})

    def stop(self, run_id: int | None = None) -> Answer:
        """Cancel a run (default: the one under way) with its Spark jobs."""
        ids = [run_id] if run_id is not None else [i for i, r in self.runs.items() if r.status == "running"]
        ids = [i for i in ids if i in self.runs and self.runs[i].status == "running"]
        if not ids:
            return Answer(404, {"error": "no run under way"})
        for i in ids:
            self._stop.add(i)
            self.runs[i].mark("cancelled")
            self._save(i)
            self.spark.sparkContext.cancelJobGroup(f"run-{i}")
        return Answer(200, {"cancelled": ids})

    def change_focus(self, path: str) -> Answer:
        """Work below another folder; an absolute path replaces the base."""
        self.state["base"] = posixpath.join("/data", path)
        return Answer(200, {"base": self.state["base"]})

    def wait(self, run_id: int, timeout: float | None = None) -> str:
        self._threads[run_id].join(timeout)
        return self.runs[run_id].status

    def _stage(self, run_id: int, entry: Entry, stage: Stage) -> None:
        entry.mark("running")
        self._save(run_id)
        for attempt in range(1, self.attempts + 1):
            if run_id in self._stop:
                raise Cancelled
            try:
                self.spark.sparkContext.setJobGroup(f"run-{run_id}", entry.name, interruptOnCancel=True)
                began = time.monotonic()
                stage(self.state)
                entry.logs.append(f"attempt {attempt}: finished in {time.monotonic() - began:.1f} s")
                entry.mark("finished")
                self._save(run_id)
                return
            except Exception as e:
                entry.logs.append(f"attempt {attempt}: {e}")
                if run_id in self._stop:
                    raise Cancelled from e
                if attempt == self.attempts:
                    entry.mark("error", str(e))
                    raise
                time.sleep(self.delay)

    def _work(self, run_id: int, numbers: list[int]) -> None:
        try:
            self._phases(run_id, numbers)
        finally:
            self._save(run_id)

    def _phases(self, run_id: int, numbers: list[int]) -> None:
        run = self.runs[run_id]
        for phase, number in zip(run.children, numbers):
            phase.mark("running")
            try:
                for entry, stage in zip(phase.children, self.phases[number][1].values()):
                    self._stage(run_id, entry, stage)
            except Cancelled:
                for e in (*phase.children, phase, run):
                    if e.status in ("running", "pending"):
                        e.mark("cancelled")
                return
            except Exception as e:
                phase.mark("error", str(e))
                run.mark("error", str(e))
                return
            phase.mark(roll_up([c.status for c in phase.children], phase.status if phase.status != "running" else "finished"))
        run.mark(roll_up([p.status for p in run.children], run.status))
