"""ORC1-ORC5: ordered steps, ranges of them, a stop at the first failure with a hint to resume, and dry runs."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Step:
    key: float
    name: str
    run: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


@dataclass
class Outcome:
    tables: dict[str, DataFrame]
    done: list[str] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)
    failed: str | None = None
    hint: str | None = None

    @property
    def ok(self) -> bool:
        return self.failed is None


def run_steps(steps: list[Step], tables: dict[str, DataFrame], first: float | None = None, last: float | None = None, sink: Callable[[str, DataFrame], DataFrame] | None = None, dry_run: bool = False) -> Outcome:
    """Run the steps with keys in [first, last] in order.

    A step gets the tables so far and returns new ones; ``sink`` stores each and returns what later steps read.  A dry run builds the plans and stores nothing.
    """
    out = Outcome(dict(tables))
    for step in sorted(steps, key=lambda s: s.key):
        if first is not None and step.key < first or last is not None and step.key > last:
            continue
        began = time.monotonic()
        try:
            made = step.run(out.tables)
            out.tables |= made if dry_run or sink is None else {k: sink(k, v) for k, v in made.items()}
        except Exception as e:
            out.failed, out.hint = f"{step.name}: {type(e).__name__}: {e}", f"resume with first={step.key:g}"
            break
        out.seconds[step.name] = time.monotonic() - began
        out.done.append(step.name)
    return out


def run_all(pipelines: dict[str, list[Step]], tables: dict[str, DataFrame], **options) -> tuple[dict[str, Outcome], bool]:
    """ORC2-ORC4: each pipeline runs whatever became of the others; the result is good only if all were."""
    outcomes = {name: run_steps(steps, tables, **options) for name, steps in pipelines.items()}
    return outcomes, all(o.ok for o in outcomes.values())
