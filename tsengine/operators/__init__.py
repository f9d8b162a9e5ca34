"""Table operators: cleaning, joins, profiles, windows, splits, metrics, selection, quality."""
