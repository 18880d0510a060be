"""Query catalogue: each module adds named queries over the driver tables, with their oracle SQL."""
