"""Reusable DataFrame operators that stay exact when one group is very large."""
