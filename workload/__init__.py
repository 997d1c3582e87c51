"""Queries over the generated test tables, one or more per operator of the library."""
