"""DataFrame operators: joins, aggregates, resampling, models and their scores."""
