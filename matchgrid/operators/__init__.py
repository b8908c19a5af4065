from matchgrid.operators import dims, filters, games, history, leaders, odds, quality, serving, windows

__all__ = ["dims", "filters", "games", "history", "leaders", "odds", "quality", "serving", "windows"]
