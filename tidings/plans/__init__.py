"""The jobs: layers, stories, enrichment, serving queries, run history."""
