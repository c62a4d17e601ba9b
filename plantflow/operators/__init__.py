"""Event-log operators: DataFrame in, DataFrame out."""
