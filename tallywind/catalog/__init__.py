"""The operators as named queries over the test tables, with SQL equivalents."""
