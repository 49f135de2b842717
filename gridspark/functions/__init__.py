from gridspark.functions import numeric, text, timefn

__all__ = ["numeric", "text", "timefn"]
