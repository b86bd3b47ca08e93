"""The jobs: one function per model."""
