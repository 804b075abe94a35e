"""operators of seriesflow."""
