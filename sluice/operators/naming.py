"""Unique names for ``Observation`` metrics (jobs may run on several threads)."""

from __future__ import annotations

import uuid


def obs_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:8]}"


def observed_values(obs) -> dict:
    """The observation's metrics; none where the plan was known to be empty, and so was never run."""
    return obs.get if obs._jo.getRow().schema() is not None else {}
