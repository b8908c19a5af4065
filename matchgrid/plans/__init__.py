from matchgrid.plans import batch, incremental

__all__ = ["batch", "incremental"]
