"""plans of seriesflow."""
