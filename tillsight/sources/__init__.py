"""Table sources: the generated test tables, the canonical star model, fixtures, sinks."""
