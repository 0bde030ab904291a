"""Reading problem tables and writing metrics and reports."""
