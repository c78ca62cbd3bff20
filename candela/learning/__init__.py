"""MLlib models on the feature frame."""
