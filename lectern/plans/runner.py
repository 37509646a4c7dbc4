"""Batch runner: decode each topic once, then build and store the views.

    python -m lectern.plans.runner [--incremental] [JOB] RAW_ROOT VIEW_ROOT
"""

from __future__ import annotations

import sys
from collections.abc import Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from lectern.plans.registry import JOBS, VIEWS, build_rolled, build_view, views_of
from lectern.session import session
from lectern.sources import rollups, versions
from lectern.sources.typed import read_typed, update_typed, write_typed
from lectern.sources.views import write_view


@dataclass
class Report:
    """Events per decoded topic, and the outcome of each job: None or its error."""

    events: dict[str, int] = field(default_factory=dict)
    jobs: dict[str, str | None] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return all(error is None for error in self.jobs.values())


def _attempt(action) -> str | None:
    try:
        action()
    except Exception as error:  # one failed view or topic must not stop the others
        return f"{type(error).__name__}: {error}"
    return None


def run(
    spark: SparkSession,
    raw_root: str,
    view_root: str,
    jobs: Iterable[str] | None = None,
    typed_root: str | None = None,
    parallel: int = 8,
    ordered: bool = False,
    incremental: bool = False,
    views: Collection[str] | None = None,
    decoded: Collection[str] = (),
) -> Report:
    """Run jobs (all by default) in one session; with `views`, only those of their views.

    The typed layer goes beside the views unless `typed_root` says otherwise.
    Writing it first means each JSON record is parsed once rather than once per
    view, and every view then reads only its columns and event types. It is a
    stored table, so a lost executor costs its running tasks, not a re-parse.

    Views are stored unordered: a reader of several files sees no order anyway,
    and a global sort costs as much again as the view. `read_view` orders on
    request; `ordered=True` also lays the stored files out in the view's order.

    `parallel` views are written at a time: the last tasks of one overlap with
    the first of the next. A failed topic or view fails the jobs that need it;
    the others go on. A missing topic is an empty one; without the master dataset itself
    nothing is written. Topics in `decoded` are read as the typed layer has them.

    With `incremental`, only directories of the master dataset that changed since the last
    such run are decoded, and the report counts their events; only the days they belong
    to are rolled up again (beside the views, `rollup_path`), and views are made from the
    rollups of all days. When all went well, the newest day becomes the horizon up to
    which `rollups.merged` relies on the batch.
    """
    wanted = list(jobs) if jobs is not None else list(JOBS)
    unknown = sorted(set(wanted) - set(JOBS))
    if unknown:
        raise ValueError(f"unknown jobs {unknown}; known are {list(JOBS)}")
    typed_root = typed_root or typed_path(view_root)
    if not versions.exists(spark, raw_root):
        raise FileNotFoundError(f"no master dataset at {raw_root}")
    todo = [v for job in wanted for v in views_of(job) if views is None or v.name in views]
    topics = [t for t in dict.fromkeys(t for v in todo for t in v.topics) if t not in decoded]

    report = Report()
    errors: dict[str, str | None] = {}

    rolled_root = rollup_path(view_root)

    def decode(topic: str) -> None:
        if incremental:
            report.events[topic] = update_rollups(spark, raw_root, view_root, topic, typed_root)
        else:
            report.events[topic] = write_typed(spark, raw_root, typed_root, topic)

    def store(name: str) -> None:
        if incremental:
            frame = build_rolled(name, lambda t: rollups.read(spark, rolled_root, t), ordered)
        else:
            frame = build_view(name, lambda t: read_typed(spark, typed_root, t), ordered)
        write_view(frame, view_root, name)

    def decode_or_record(topic: str) -> None:
        errors[topic] = _attempt(lambda: decode(topic))

    def store_or_record(name: str) -> None:
        failed = next((errors[t] for t in VIEWS[name].topics if errors.get(t)), None)
        errors[name] = failed or _attempt(lambda: store(name))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(inheritable_thread_target(spark)(decode_or_record), topics))
        list(pool.map(inheritable_thread_target(spark)(store_or_record), [v.name for v in todo]))

    for job in wanted:
        report.jobs[job] = next(
            (f"{v.name}: {errors[v.name]}" for v in views_of(job) if errors.get(v.name)), None
        )
    if incremental and report.ok:
        rollups.set_horizon(spark, rolled_root, topics)
    return report


def update_rollups(
    spark: SparkSession, raw_root: str, view_root: str, topic: str, typed_root: str | None = None
) -> int:
    """The incremental run of one topic as far as its rollups; returns the events it decoded."""
    typed_root = typed_root or typed_path(view_root)
    decoded = update_typed(spark, raw_root, typed_root, topic)
    rollups.update(spark, typed_root, rollup_path(view_root), topic)
    return decoded


def typed_path(view_root: str) -> str:
    """Where a run keeps the typed layer, unless told otherwise."""
    return f"{view_root.rstrip('/')}_typed"


def rollup_path(view_root: str) -> str:
    """Where an incremental run keeps the rollups of the views."""
    return f"{view_root.rstrip('/')}_rollups"


def main(arguments: list[str]) -> int:
    incremental = "--incremental" in arguments
    arguments = [a for a in arguments if a != "--incremental"]
    if len(arguments) not in (2, 3):
        print(__doc__)
        print(f"    jobs: {', '.join(JOBS)}")
        return 2
    *job, raw_root, view_root = arguments
    report = run(session("lectern batch views"), raw_root, view_root, job or None, incremental=incremental)
    for topic, rows in report.events.items():
        print(f"{topic}: {rows} events")
    for name, error in report.jobs.items():
        print(f"{name}: {error or 'ok'}")
    return 0 if report.ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
