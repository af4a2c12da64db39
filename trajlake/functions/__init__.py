"""Column -> Column helpers: action types, arm vectors, time conversions."""
