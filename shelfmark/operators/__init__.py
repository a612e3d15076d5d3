"""Warehouse jobs: merges, queues, similarity, repairs, normalisation, star schema."""
