"""Column-level helpers: null/NaN rules, text rules, aggregate name map, expressions."""
