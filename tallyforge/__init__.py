"""Account-value analytics on Spark: operators, named plans and their SQL twins."""
