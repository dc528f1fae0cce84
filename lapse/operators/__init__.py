"""DataFrame operators, grouped by stage: explore, features, ranking, metrics,
calibrate, decide, learn."""
