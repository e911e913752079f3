"""Relational operators of the engine, one module per family."""
