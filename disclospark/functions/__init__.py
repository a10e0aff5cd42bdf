"""Column-to-column expressions; all stay inside whole-stage codegen."""
