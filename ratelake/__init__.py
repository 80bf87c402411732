"""Versioned rate tables on Spark: gate, normalise, diff, compare, apply, report."""
