"""Domain plans: population, category dimensions, features, wide table, model."""
