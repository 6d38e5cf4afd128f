"""Reading the five input tables and writing the reports."""
