"""Composed runs: operators joined into the published analyses."""
