"""DataFrame operators: checks, duplicates, profile, silver, gold, calendar, reconciliation."""
