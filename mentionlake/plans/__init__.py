"""Jobs: landing to bronze, bronze to silver, silver to mentions, and the marts."""
