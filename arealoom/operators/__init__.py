"""Table operators. None depends on row order: every keep-first rule takes an explicit order."""
