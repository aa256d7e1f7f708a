"""Play-event vocabulary of a pitch-by-pitch feed, for running the operators on
real play data (the test tables use the stand-in vocabulary in
``plans/standins.py``).

Fixed values (event names and category membership as used by the rate-stat
leaderboards; outs recorded per event; bases per hit kind):
"""

from __future__ import annotations

from diamondlake.operators.aggregates import NOT_NULL

# Event categories of the leaderboard counts.
HIT_EVENTS = ["home_run", "triple", "double", "single"]
AT_BAT_EVENTS = ["home_run", "triple", "double", "single", "double_play", "field_error", "fielders_choice",
                 "fielders_choice_out", "field_out", "force_out", "grounded_into_double_play", "strikeout",
                 "strikeout_double_play", "triple_play"]
ON_BASE_EVENTS = ["home_run", "triple", "double", "single", "walk", "hit_by_pitch"]
SAC_FLY_EVENTS = ["sac_fly", "sac_fly_double_play"]
WALK_EVENTS = ["walk", "hit_by_pitch"]

# Outs recorded per play event.
OUTS_BY_EVENT = {
    "double": 0, "double_play": 2, "field_out": 1, "fielders_choice": 0, "fielders_choice_out": 1,
    "force_out": 1, "grounded_into_double_play": 2, "hit_by_pitch": 0, "home_run": 0, "sac_bunt": 1,
    "sac_bunt_double_play": 2, "sac_fly": 1, "sac_fly_double_play": 2, "single": 0, "strikeout": 1,
    "strikeout_double_play": 2, "triple": 0, "triple_play": 3, "walk": 0, "catcher_interf": 0, "field_error": 0,
}

# Worth of a way on base (anything else is worth 0).
HIT_VALUE = {"single": 1.0, "double": 2.0, "triple": 3.0, "home_run": 4.0, "walk": 0.5, "hit_by_pitch": 0.5}


def batting_categories() -> dict:
    """Category spec for ``aggregates.conditional_counts`` on real play events."""
    return {
        "hit_count": HIT_EVENTS, "total_ab": AT_BAT_EVENTS, "num_obp": ON_BASE_EVENTS, "sf": SAC_FLY_EVENTS,
        "walks": WALK_EVENTS, "only_walks": ["walk"], "only_hit_by_pitch": ["hit_by_pitch"],
        "num_singles": ["single"], "num_doubles": ["double"], "num_triples": ["triple"], "num_hrs": ["home_run"],
        "num_pa": NOT_NULL,
    }
