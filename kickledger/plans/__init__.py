"""The registered query catalog and the end-to-end pipeline."""
