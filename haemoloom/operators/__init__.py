"""DataFrame operators: cleaning, sessions, joins, bins, windows, risk and metrics."""
