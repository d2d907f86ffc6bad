"""Errors raised by the package."""


class DataValidationError(ValueError):
    """The input cannot be used: a required column is missing or there is no row."""


class ModelTrainingError(ValueError):
    """A forecast was asked for with arguments no model can honour."""
