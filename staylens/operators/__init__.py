"""Query-level operators: each a function ``DataFrame(s) -> DataFrame``."""
