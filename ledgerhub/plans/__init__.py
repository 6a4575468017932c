"""Jobs a user calls, composed from the operators."""
