"""Registered queries and the equivalent SQL, by subject."""
