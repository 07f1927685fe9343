"""See the package docstring of lodestream."""
