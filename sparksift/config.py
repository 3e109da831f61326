"""Run configuration, passed to the plan builders."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Thresholds flag at `high` or more and clear at `low` or less; an export part holds at most max_links links and max_bytes bytes."""

    # Concurrency of calls and of checks, caps of an export part, monthly tokens.
    ai_concurrency: int = 12
    check_concurrency: int = 20
    monthly_tokens: int = 1_500_000_000
    max_links: int = 1_000
    max_bytes: int = 24_000_000
    low: float = 0.05
    high: float = 0.95
    fast_mode: bool = False
    fast_confidence: float = 0.9
    excerpt_chars: int = 2_000
    json_retries: int = 2

    @classmethod
    def local(cls, **changed) -> Config:
        """Settings for models on one machine: fewer calls and checks at once, and fast mode."""
        # Concurrency of calls and of checks, fast mode.
        return cls(**({"ai_concurrency": 3, "check_concurrency": 10, "fast_mode": True} | changed))
