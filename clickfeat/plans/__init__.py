"""Stage plans and the registered query catalogue (queries + oracle SQL)."""
