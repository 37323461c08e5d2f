"""Models (Spark ML), ensembles, metrics, residual tests, validation, importance and tuning."""
