"""Operators that prepare training text: one module per operator, their queries and their SQL."""
