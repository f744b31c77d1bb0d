"""Declarative step lists, the four reports, and the registry of checked queries."""
