"""Column roles of an event table.

Every operator takes its column names from an ``EventConfig`` so the same
pipeline runs on any ordered event table.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class EventConfig:
    entity: str = "posteam"          # side whose events these are
    opponent: str = "defteam"        # the other side
    season: str = "season"
    period: str = "game_date"        # one period = one date inside a season
    week: str = "week"
    order: tuple = ("drive", "play_id")   # event order inside a period
    actor: str = "passer"
    game: str = "game_id"
    label: str = "play_type"
    # neutral-state thresholds on ``wp`` (exclusive bounds)
    neutral_lo: float = 0.1
    neutral_hi: float = 0.9
    scripted_k: int = 15
    measures: tuple = ("epa", "wpa")
    extra: dict = field(default_factory=dict)

    @property
    def order_cols(self) -> list[str]:
        return list(self.order)
