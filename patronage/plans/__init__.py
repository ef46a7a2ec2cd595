"""The jobs users run."""
