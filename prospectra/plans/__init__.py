"""End-to-end plans: prepare a dataset, train a model, score rows."""
