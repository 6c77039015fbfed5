"""Shared plan shapes (distributed prefix sums, metric search) and the query catalogue."""
