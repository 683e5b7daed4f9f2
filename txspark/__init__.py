"""DataFrame operators for genome-annotation and transcript-feature tables."""
