"""tidepool.operators."""
