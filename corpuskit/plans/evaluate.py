"""Evaluation by a foreign program: its specifications as a file, the program's run, its results as tables."""

from __future__ import annotations

import os
import subprocess
from collections.abc import Callable

from pyspark.sql import DataFrame

from corpuskit.sources.sinks import write_text


def run_program(command: list[str], paths: list[str] = (), timeout: float | None = None) -> int:
    """Run a program on the driver, with ``paths`` in front of its Python path; gives its exit code."""
    there = [p for p in (*paths, os.environ.get("PYTHONPATH", "")) if p]
    return subprocess.run(command, env=os.environ | ({"PYTHONPATH": ":".join(there)} if there else {}), timeout=timeout).returncode


def evaluate(specs: DataFrame, path: str, command: Callable[[str], list[str]], runner: Callable[[list[str]], int] = run_program) -> int:
    """Write the specs (a run each) to ``path``, one per line, and start the program that ``command`` names for it; a failure raises."""
    lines = [r.spec for r in specs.select("spec", "benchmark", "place").orderBy("benchmark", "place", "spec").collect()]  # a run each
    write_text(specs.sparkSession, path, "".join(f"{x}\n" for x in lines))
    code = runner(command(path))
    if code:
        raise RuntimeError(f"the evaluator ended with code {code}")
    return len(lines)
