"""The three layers, their earlier variants and the reports."""
