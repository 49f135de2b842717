from gridspark.models import features, fourier, score, smoothing, spectral, temp_response

__all__ = ["features", "fourier", "score", "smoothing", "spectral", "temp_response"]
