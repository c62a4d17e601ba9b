"""Reports: the results users look at."""
