"""Column functions: everything here is built from Spark's own expressions (no Python UDF)."""

from matchgrid.functions.dates import (
    cfb_season_type,
    cfb_week,
    day_of_week,
    game_start,
    nba_season_type,
    news_date,
    nfl_season_type,
    nfl_week,
    nhl_season_type,
    odds_window_minutes,
    utc_partition,
)
from matchgrid.functions.ids import news_id, odds_id, surrogate_key
from matchgrid.functions.odds import implied_probability, odds_value
from matchgrid.functions.scores import (
    int_scores,
    overtime_count,
    overtime_scores,
    period_score,
    record_favorite,
    record_losses,
    record_wins,
    score_total,
    win_share,
)
from matchgrid.functions.weather import severity_points, weather_condition, wind_direction

__all__ = [
    "cfb_season_type", "cfb_week", "day_of_week", "game_start", "implied_probability", "int_scores",
    "nba_season_type", "news_date", "news_id", "nfl_season_type", "nfl_week", "nhl_season_type", "odds_id",
    "odds_value", "odds_window_minutes", "overtime_count", "overtime_scores", "period_score",
    "record_favorite", "record_losses", "record_wins", "score_total", "severity_points", "surrogate_key",
    "utc_partition", "weather_condition", "win_share", "wind_direction",
]
