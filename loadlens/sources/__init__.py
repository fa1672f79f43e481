"""Reading tables, writing targets, staging intermediates."""
