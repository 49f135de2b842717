from gridspark.sources import elec, listing, meter, series_json, sinks, warehouse, weather

__all__ = ["elec", "listing", "meter", "series_json", "sinks", "warehouse", "weather"]
