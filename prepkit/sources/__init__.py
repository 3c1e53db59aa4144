"""Reading delimited text and tables; writing versions, splits, models and metrics."""
