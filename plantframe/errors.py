"""Errors raised at the API edge. Row-level failures are data first (see ``MergeResult.errors``)."""


class PlantError(ValueError):
    """A request or a row that the engine refuses."""
