"""Column helpers: missing values, text, dates and recodes."""
