"""Reading comment files, writing result tables, saved state."""
