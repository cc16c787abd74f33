"""Table operators for location-aware price analytics on classified ads, on Spark."""
