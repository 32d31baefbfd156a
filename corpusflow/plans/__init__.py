"""Shared distribution plans: block joins, ranking, size checks, materialisation."""
