"""Column expressions shared by the jobs. All are built-in functions; there is no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressure.config import RULES, Rules


def team_name(raw: str, rules: Rules = RULES) -> Column:
    """Team name without its competition prefix (a literal replace: the prefix has parentheses)."""
    return F.replace(F.col(raw), F.lit(rules.team_prefix), F.lit(""))


def is_kept_league(raw_home: str, rules: Rules = RULES) -> Column:
    return F.col(raw_home).startswith(rules.kept_league_prefix)


def clock_to_seconds(clock: str) -> Column:
    """Seconds left on an MM:SS clock; padding is allowed, a bad clock is an error."""
    minutes = F.split_part(F.col(clock), F.lit(":"), F.lit(1)).cast("int")
    seconds = F.split_part(F.col(clock), F.lit(":"), F.lit(2)).cast("int")
    return minutes * 60 + seconds


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def from_own_side(is_home: str, home: str, away: str) -> Column:
    """The home value for the home side, else the away value (also when the side is unknown)."""
    return F.when(F.col(is_home), F.col(home)).otherwise(F.col(away))


def strength(own: str, other: str, rules: Rules = RULES) -> Column:
    mine, theirs = F.col(own), F.col(other)
    return (
        F.when(mine == rules.extra_attacker_skaters, "EA")
        .when(theirs == rules.extra_attacker_skaters, "EN")
        .when(mine > theirs, "PP")
        .when(mine < theirs, "PK")
        .otherwise("EV")
    )


def skaters_label(own: str, other: str) -> Column:
    return F.concat(F.col(own).cast("string"), F.lit("v"), F.col(other).cast("string"))


def zone(x: str, rules: Rules = RULES) -> Column:
    return (
        F.when(F.col(x) >= rules.offensive_from_x, "OZ")
        .when(F.col(x) <= rules.defensive_to_x, "DZ")
        .otherwise("NZ")
    )


def second_player_team(event: str, own: str, other: str, rules: Rules = RULES) -> Column:
    """The team of the second player: the opponent on contested events, else the acting team."""
    contested = F.col(event).isin(*rules.opponent_second_player_events)
    return F.when(contested, F.col(other)).otherwise(F.col(own))


def grid_bin(value: Column, cell: int, last: int) -> Column:
    """Cell number, the last cell taking everything beyond it; an unknown value falls there too."""
    return F.least(F.floor(value / F.lit(cell)).cast("double"), F.lit(float(last)))


def share(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double")


def label(code: str, labels: dict[str, str]) -> Column:
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.create_map(*pairs)[F.col(code)]
