"""File sources, corpora derived from tables, and sinks."""
