"""Assemblies of operators: layer builds, the registered query catalog and the
SQL oracle used to check it."""
