"""Column -> Column expressions. They need no session and stay inside whole-stage codegen."""
