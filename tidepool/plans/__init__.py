"""tidepool.plans."""
