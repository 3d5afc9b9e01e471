"""Settings from the environment."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

#: Recordings longer than this (seconds) are read block by block.
STREAM_SECS = 54_000.0


@dataclass(frozen=True)
class Config:
    stream_secs: float = STREAM_SECS
    user_agent: str = "cantor/0.1"
    model: str = "letters"


def positive(text: str | None, default: float) -> float:
    """A finite number over 0, else the default."""
    try:
        x = float(text) if text and text.strip() else math.nan
    except ValueError:
        return default
    return x if math.isfinite(x) and x > 0 else default


def load(env: Mapping[str, str] = os.environ) -> Config:
    return Config(
        stream_secs=positive(env.get("CANTOR_STREAM_SECS"), STREAM_SECS),
        user_agent=env.get("CANTOR_USER_AGENT") or Config.user_agent,
        model=env.get("CANTOR_MODEL") or Config.model,
    )
