"""Column functions: text splitting, routing and strict or lenient conversions."""
