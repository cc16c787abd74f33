"""The three end-to-end flows: cleaning, location features, valuation."""
