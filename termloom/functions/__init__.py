"""Part of termloom; see the package docstring."""
