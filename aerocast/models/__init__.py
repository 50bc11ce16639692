"""Training, scoring and storage of the forecast models."""
