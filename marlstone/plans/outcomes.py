"""Running several independent parts of a job."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

log = logging.getLogger("marlstone")


@dataclass(frozen=True)
class Outcome:
    name: str
    ok: bool
    detail: object


def run_each(names: Iterable[str], run: Callable[[str], object]) -> list[Outcome]:
    """Run every part, recording failures instead of stopping at the first."""
    outcomes = []
    for name in names:
        try:
            outcomes.append(Outcome(name, True, run(name)))
        except Exception as problem:  # noqa: BLE001 - reported, and turned into the exit status
            log.exception("%s failed", name)
            outcomes.append(Outcome(name, False, str(problem)))
    return outcomes


def exit_status(outcomes: Iterable[Outcome]) -> int:
    return 0 if all(o.ok for o in outcomes) else 1
