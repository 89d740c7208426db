"""Where the tables of one installation live."""

from __future__ import annotations

from dataclasses import dataclass

from wattspan.functions.calendar import GRAINS


@dataclass(frozen=True)
class Store:
    """Paths below one root folder every executor can reach."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def feeds(self) -> str:
        return self.path("feeds")

    @property
    def office(self) -> str:
        return self.path("office")

    @property
    def readings(self) -> str:
        return self.path("readings")

    @property
    def hour_state(self) -> str:
        return self.path("hour_state")

    @property
    def flags(self) -> str:
        return self.path("flags")

    @property
    def threshold_state(self) -> str:
        return self.path("threshold_state")

    @property
    def feed_ends(self) -> str:
        return self.path("feed_ends")

    @property
    def load_log(self) -> str:
        return self.path("load_log")

    @property
    def model(self) -> str:
        return self.path("model")

    @property
    def forecasts(self) -> str:
        return self.path("forecasts")

    def sketches(self, grain: str) -> str:
        return self.path(f"sketches_{grain}")

    def agg(self, grain: str) -> str:
        if grain not in GRAINS:
            raise ValueError(f"unknown grain {grain!r}")
        return self.path(f"agg_{grain}")
