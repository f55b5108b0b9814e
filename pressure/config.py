"""Domain constants and size limits, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """What the log means. Changing one changes the results."""

    kept_league_prefix: str = "Olympic"
    kept_league: str = "Olympic"
    team_prefix: str = "Olympic (Women) - "
    period_seconds: int = 1200
    offensive_from_x: int = 125
    defensive_to_x: int = 75
    extra_attacker_skaters: int = 6
    shot_events: tuple[str, ...] = ("Shot", "Goal")
    win_events: tuple[str, ...] = ("Puck Recovery", "Takeaway")
    stoppage_events: tuple[str, ...] = ("Faceoff Win", "Penalty Taken")
    opponent_second_player_events: tuple[str, ...] = ("Faceoff Win", "Penalty Taken", "Zone Entry")
    window_seconds: int = 10
    grid_origin_x: int = 125
    grid_cell_x: int = 15
    grid_cell_y: int = 17
    grid_last_bin: int = 4
    grid_centre_x: float = 100.0
    grid_centre_y: float = 42.5
    table_minimum: int = 20
    table_minimum_filtered: int = 5
    table_minimum_player: int = 1


@dataclass(frozen=True)
class Limits:
    """How much one task may be asked to hold. These never change a result."""

    # A group with more rows than this is cut into runs of `chunk_rows` rows.
    group_rows: int = 2_000_000
    chunk_rows: int = 1_000_000
    # A table with more rows than this is numbered range by range, not in one task.
    one_task_rows: int = 1_000_000
    # File blocks joined back by broadcast; two integers each, so 64 MB at most.
    broadcast_rows: int = 4_000_000


# How a win came about.
WIN_TYPES = (
    "Rebound",
    "Faceoff",
    "Forecheck Retrieval",
    "Forced Turnover",
    "Support",
    "Other / Loose Puck",
)
# End reason -> label shown to people.
END_REASON_LABELS = {
    "shot": "Shot",
    "opponent_possession": "Opponent got it back",
    "time_expired": "Kept it, no shot in 10s",
    "stoppage": "Whistle",
}
# Even, power play, short-handed, against an empty net, with an extra attacker.
STRENGTHS = ("EV", "PP", "PK", "EN", "EA")

RULES = Rules()
LIMITS = Limits()
