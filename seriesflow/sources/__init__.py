"""sources of seriesflow."""
