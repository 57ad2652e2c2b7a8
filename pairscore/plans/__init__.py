"""End-to-end plans: feature sets, models, evaluation, query catalogue."""
