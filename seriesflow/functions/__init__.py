"""functions of seriesflow."""
