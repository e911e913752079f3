"""Execution helpers: lineage cuts in the shared folder, size-checked broadcasts."""
