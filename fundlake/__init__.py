"""Funding-delivery analytics on Spark: raw deliveries to typed, stacked and enrolment-wide tables."""
