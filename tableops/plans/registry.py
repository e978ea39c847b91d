"""Name -> job and name -> oracle SQL."""

from __future__ import annotations

from . import file_jobs, jobs
from .oracle import ORACLE as _ORACLE

QUERIES = {
    name[2:]: fn
    for module in (jobs, file_jobs)
    for name, fn in vars(module).items()
    if name.startswith("q_") and callable(fn) and getattr(fn, "__module__", "") == module.__name__
}
ORACLE = {k: v for k, v in _ORACLE.items() if k in QUERIES}
