"""streaming of seriesflow."""
