"""End-to-end jobs: preparing wells, training a basin, packaging and batch scoring."""
