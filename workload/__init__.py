"""The library's operators bound to the test tables, each with the SQL it must agree with."""
