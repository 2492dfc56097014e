"""Column functions: no DataFrame, no session, everything inside whole-stage codegen."""
