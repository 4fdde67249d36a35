"""From archives to the raw layer."""
