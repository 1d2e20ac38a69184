"""DataFrame operators: finding cases, cohorts, pairs, signals, comparison, features, models."""
