"""tidemart: change feeds and app logs to dimensions, facts and window summaries, on Spark."""
