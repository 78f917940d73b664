"""Column -> Column functions; all of them stay inside whole-stage codegen."""
