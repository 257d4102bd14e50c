"""The library's operators as named queries over the given tables."""
