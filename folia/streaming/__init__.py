"""Streaming front ends; batch operators stay the definition of every result."""
