"""Reading and writing of listings, layers, stage tables, predictions and reports."""
