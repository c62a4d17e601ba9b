"""The same jobs as continuous queries."""
