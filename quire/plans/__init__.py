"""Conversion plans, stage composition and the assessment report."""
