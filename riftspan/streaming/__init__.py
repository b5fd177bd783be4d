"""Intentionally empty: every operation of this engine is a bounded batch job over finite files."""
