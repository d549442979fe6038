"""tidepool.functions."""
