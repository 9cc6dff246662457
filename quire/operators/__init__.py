"""DataFrame operators: sections, features, scoring, near duplicates, classification, topics."""
