"""Column helpers; every one is a composition of built-in Spark functions."""
