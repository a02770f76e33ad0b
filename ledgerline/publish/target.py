"""Where a run publishes to."""

from __future__ import annotations

import os
from collections.abc import Mapping

TARGETS = ("dev", "prod")
DEFAULT_TARGET = "dev"
TARGET_VARIABLE = "LEDGERLINE_TARGET"


def resolve_target(
    param: str | None = None,
    run_conf: Mapping[str, str] | None = None,
    env: Mapping[str, str] | None = None,
) -> str:
    """The first valid choice among the parameter, the run's configuration and the environment.

    An unknown name is skipped and never read as production, which has to be asked for.
    """
    env = os.environ if env is None else env
    for choice in (param, (run_conf or {}).get("target"), env.get(TARGET_VARIABLE)):
        if choice in TARGETS:
            return choice
    return DEFAULT_TARGET
