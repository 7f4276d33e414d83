"""Column-level building blocks: native expressions, no shuffles."""
