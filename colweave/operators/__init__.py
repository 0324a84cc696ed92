"""Table operators: each ``fit`` yields a small parameter object, each ``apply`` a projection or join."""
