"""A chain of stages that stops at the first fatal failure and keeps a record of it."""

from __future__ import annotations

import json
import os
import subprocess
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass


@dataclass
class Stage:
    """Either a command or a function; a stage that isn't fatal may fail."""

    name: str
    command: list[str] | None = None
    function: Callable[[], int | None] | None = None
    fatal: bool = True
    enabled: bool = True


@dataclass
class StageResult:
    name: str
    returncode: int
    seconds: float
    log: str


def tail(text: str, n: int = 20) -> str:
    return "\n".join(text.splitlines()[-n:])


def run_stages(stages: list[Stage], folder: str, emit: Callable[[str], None] = print) -> list[StageResult]:
    """Each stage's output goes to folder/<name>.log; last_failure.json tells of a fatal failure."""
    os.makedirs(folder, exist_ok=True)
    failure = os.path.join(folder, "last_failure.json")
    if os.path.exists(failure):
        os.remove(failure)
    results = []
    for stage in stages:
        if not stage.enabled:
            continue
        emit(f"== {stage.name}")
        log, began, code = os.path.join(folder, f"{stage.name}.log"), time.monotonic(), 0
        with open(log, "w", encoding="utf-8") as out:
            try:
                if stage.command:
                    code = subprocess.run(stage.command, stdout=out, stderr=subprocess.STDOUT, check=False).returncode
                elif stage.function:
                    code = stage.function() or 0
            except Exception as e:
                out.write(f"{type(e).__name__}: {e}\n")
                code = 1
        results.append(StageResult(stage.name, code, time.monotonic() - began, log))
        if code:
            with open(log, encoding="utf-8") as f:
                emit(tail(f.read()))
            if stage.fatal:
                with open(failure, "w", encoding="utf-8") as f:
                    json.dump(asdict(results[-1]), f)
                break
    return results


def report(results: list[StageResult]) -> str:
    return "\n".join(f"{r.name:20} {'ok' if not r.returncode else f'failed ({r.returncode})':12} {r.seconds:8.1f} s" for r in results)
