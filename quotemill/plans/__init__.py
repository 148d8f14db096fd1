"""The query catalogue: every query with its equivalent SQL."""
