"""Sources, sinks and the adapters that derive record-shaped inputs from tables."""
