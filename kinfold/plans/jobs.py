"""Orchestration: source jobs first, side by side, then the resolver."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field


@dataclass
class Registry:
    """Pluggable source jobs that land JSON lines: sanctions by key, media jobs with their facts."""

    sanctions: dict[str, Callable[[], object]] = field(default_factory=dict)
    media: dict[str, dict] = field(default_factory=dict)
    media_job: Callable[[], object] | None = None

    def rows(self, sanctions: bool = False, media: bool = False) -> list[dict]:
        """One row per source; no choice means both kinds."""
        both = not (sanctions or media)
        out = []
        if sanctions or both:
            out += [{"kind": "sanctions", "key": k, "status": "ACTIVE" if callable(f) else "ERROR"} for k, f in self.sanctions.items()]
        if media or both:
            out += [{"kind": "media", "key": k, "status": "ACTIVE", **facts} for k, facts in self.media.items()]
        return out


def run_sources(jobs: dict[str, Callable[[], object]], limit: int = 3) -> dict[str, str]:
    """Run jobs, at most ``limit`` at once; a failing job is reported and stops no other."""

    def one(item):
        key, job = item
        try:
            job()
            return key, "OK"
        except Exception as e:
            return key, f"FAIL: {e}"

    with ThreadPoolExecutor(max(1, limit)) as pool:
        return dict(pool.map(one, jobs.items()))


def orchestrate(registry: Registry, resolver: Callable[[], object], limit: int = 3, sanctions: bool = True, media: bool = True, resolve: bool = True, run=run_sources) -> dict:
    """Phase 1: sanctions and media side by side; phase 2: the resolver.

    The resolver is skipped only if the sanctions phase itself broke; failures of
    single sources, or of media, never stop it.
    """
    began = time.time()
    out: dict = {"sanctions": "SKIP", "media": "SKIP", "resolver": "SKIP"}
    with ThreadPoolExecutor(2) as pool:
        first = pool.submit(run, registry.sanctions, limit) if sanctions else None
        second = pool.submit(registry.media_job) if media and registry.media_job else None
        blocked = False
        for name, task in (("sanctions", first), ("media", second)):
            if task is not None:
                try:
                    out[name], out[f"{name}_result"] = "OK", task.result()
                except Exception as e:
                    out[name] = f"FAIL: {e}"
                    blocked |= name == "sanctions"
    if resolve and not blocked:
        try:
            out["resolver_result"] = resolver()
            out["resolver"] = "OK"
        except Exception as e:
            out["resolver"] = f"FAIL: {e}"
    out["seconds"] = time.time() - began
    return out
