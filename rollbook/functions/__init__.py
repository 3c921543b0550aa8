"""Column helpers: dates, text, recodes, first-row picks and range joins."""
