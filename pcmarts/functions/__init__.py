"""Column builders: money, dates, text rules, bands."""
