"""Column → Column helpers: Python-regex semantics on Java/RE2, text and path functions."""
