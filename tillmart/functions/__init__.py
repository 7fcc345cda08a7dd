"""Column-level building blocks: masks, calendar truncation, named measures."""
