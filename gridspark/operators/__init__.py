from gridspark.operators import align, grid, quality, select, series, stats, upsert

__all__ = ["align", "grid", "quality", "select", "series", "stats", "upsert"]
