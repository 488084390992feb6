"""What a run will cost: hours from seconds an ad, node hours from hours."""

from __future__ import annotations

from itertools import product

#: Node hours of one GPU hour: a fixed value.
NODE_HOUR_FACTOR = 0.25


def gpu_hours(seconds_per_ad, ads):
    return seconds_per_ad * ads / 3600


def node_hours(hours):
    return hours * NODE_HOUR_FACTOR


def estimate(seconds_per_ad: dict[str, float], ads: int) -> dict[str, dict[str, float]]:
    """Hours and node hours of each step and in total."""
    out = {k: {"hours": gpu_hours(s, ads), "node_hours": node_hours(gpu_hours(s, ads))} for k, s in seconds_per_ad.items()}
    out["total"] = {k: sum(x[k] for x in out.values()) for k in ("hours", "node_hours")}
    return out


def job_plan(models: dict[str, list[str]]) -> list[dict[str, str | None]]:
    """Jobs that try every model of each kind once: one of each kind together, the first of a kind where it has no more."""
    n = max((len(v) for v in models.values()), default=0)
    return [{k: (v[i] if i < len(v) else v[0]) if v else None for k, v in models.items()} for i in range(n)]


def planned_runs(fixed: dict[str, list[str]], models: dict[str, list[str]]) -> list[dict[str, str]]:
    """Each kind of model varied over all of its models, with every combination of the fixed models of the other kinds.

    A combination that several arms ask for is run once, where it first comes up.
    """
    out: dict[tuple[str, ...], dict[str, str]] = {}
    for varied in models:
        choices = [models[k] if k == varied else fixed[k] for k in models]
        for combination in product(*choices):
            out.setdefault(combination, dict(zip(models, combination, strict=True)))
    return list(out.values())
