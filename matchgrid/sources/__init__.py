from matchgrid.sources import boxscore, files, news_feed, odds_feed, reshape, scoreboard, weather_feed

__all__ = ["boxscore", "files", "news_feed", "odds_feed", "reshape", "scoreboard", "weather_feed"]
