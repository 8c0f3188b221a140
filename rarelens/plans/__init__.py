"""Multi-step plans: fitted features, models, search, scoring and explanation."""
