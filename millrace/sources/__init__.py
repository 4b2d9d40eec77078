"""Reading and writing JSON Lines, and the bindings of the test tables."""
