"""Settings of a run: weights, thresholds and limits, with defaults that a JSON file may replace."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields


@dataclass(frozen=True)
class Rewards:
    validity: float = 0.3
    consistency: float = 0.2
    keyword: float = 0.5
    penalty_cap: float = 0.3


@dataclass(frozen=True)
class Judge:
    """How replies are asked for: attempts, seconds between them, requests at a time."""

    attempts: int = 3
    delay: float = 1.0
    at_once: int = 10


@dataclass(frozen=True)
class Settings:
    rewards: Rewards = field(default_factory=Rewards)
    judge: Judge = field(default_factory=Judge)
    confirmed_share: float = 0.6
    val_ratio: float = 0.1
    candidates_a_type: int = 50

    @classmethod
    def of(cls, text: str | None) -> Settings:
        """From JSON text; unknown names are an error."""
        given = json.loads(text) if text else {}
        if unknown := set(given) - {f.name for f in fields(cls)}:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        parts = {"rewards": Rewards, "judge": Judge}
        return cls(**{k: parts[k](**v) if k in parts else v for k, v in given.items()})

    def as_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)
