"""The analytic tables. Each function takes and returns DataFrames and starts no job."""
