from gridspark.plans import forecast, load, matrix

__all__ = ["forecast", "load", "matrix"]
