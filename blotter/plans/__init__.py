"""The jobs (one function per program) and the registered query catalog."""
