from gridspark.streaming import batches, dayahead, hourly, merge, refresh

__all__ = ["batches", "dayahead", "hourly", "merge", "refresh"]
