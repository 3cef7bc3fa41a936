"""Column-level building blocks: every helper takes and returns Spark columns."""
