"""DataFrame operators. Each takes and returns DataFrames covering all clients at once."""
