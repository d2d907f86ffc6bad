"""Panel forecasting models and their comparison."""
