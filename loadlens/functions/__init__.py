"""Column -> Column helpers: keys and text, dates, rules, named expressions."""
