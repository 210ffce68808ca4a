"""DataFrame -> DataFrame operators: preparation, splitting, models, ranking, metrics."""
