"""DataFrame operators: cleaning, checks, merge, stations, conditions, extremes."""
