from matchgrid.streaming import live, runner

__all__ = ["live", "runner"]
