"""Data checks (queries that return offending rows) and the defects that prove them."""
