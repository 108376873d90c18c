"""Relations of the marts, one function each."""
