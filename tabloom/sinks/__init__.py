"""Writers for predictions, fitted pipelines and models."""
