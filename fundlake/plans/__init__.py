"""Whole jobs: normalise deliveries, stack them, build the wide tables, report."""
