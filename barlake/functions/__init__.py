"""Column-level building blocks: name rules, expressions and text templates."""
