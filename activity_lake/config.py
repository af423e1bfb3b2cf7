"""Settings of the pipeline. Paths and connections come from the caller or the environment, never from code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Transport modes whose commute is validated, how the lookup names them, and the greatest distance
# in km that still counts as coherent.
SOFT_MODE_LABELS = ("Vélo/Trottinette/Autres", "Marche/running")
LOOKUP_MODES = {2: "walking", 3: "bicycling"}
MAX_KM = {2: 15.0, 3: 25.0}

# The sports an activity may name.
SPORTS = ("Course à pied", "Vélo", "Natation", "Marche", "Trotinette", "Voile")

# Comments and ranges of synthetic activities.
COMMENTS = (
    "Super séance, je me suis senti(e) en pleine forme !",
    "Pas mal, mais j'ai eu du mal à trouver mon rythme.",
    "A refaire très vite !",
    "J'ai adoré cette activité, c'était vraiment génial !",
)
KM_RANGE = (1, 14)
SECONDS_RANGE = (600, 3599)
FIRST_DAY = "2025-01-01"
DAYS = 365

# Steps of the dashboard gauges.
DISK_STEPS = (("green", 0), ("orange", 70), ("red", 90))
MEMORY_STEPS = (("green", 0), ("orange", 75), ("red", 90))
COUNT_STEPS = (("green", 0), ("red", 80))

TRIGGER_INTERVAL = "30 seconds"
POLL_INTERVAL = "10 seconds"
METRICS_INTERVAL = "60 seconds"


@dataclass(frozen=True)
class MobilityRules:
    """Which employees are validated (by mode label) and against what (by mode id)."""

    labels: tuple[str, ...] = SOFT_MODE_LABELS
    lookup_modes: Mapping[int, str] = field(default_factory=lambda: dict(LOOKUP_MODES))
    max_km: Mapping[int, float] = field(default_factory=lambda: dict(MAX_KM))


@dataclass(frozen=True)
class LakePaths:
    """Every location below one root; any Hadoop file system will do."""

    root: str

    @classmethod
    def from_env(cls, variable: str = "ACTIVITY_LAKE_ROOT") -> LakePaths:
        return cls(os.environ[variable].rstrip("/"))

    def _at(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def bronze(self) -> str:
        return self._at("bronze")

    @property
    def silver(self) -> str:
        return self._at("silver")

    @property
    def distance_cache(self) -> str:
        return self._at("distance_cache")

    @property
    def event_state(self) -> str:
        """State by batch id, which means nothing without the checkpoint it lies in."""
        return f"{self.checkpoint('silver')}/event_state"

    @property
    def outbox(self) -> str:
        return self._at("outbox")

    @property
    def metrics(self) -> str:
        return self._at("metrics")

    def checkpoint(self, stream: str) -> str:
        return self._at(f"checkpoints/{stream}")
