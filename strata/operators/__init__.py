"""DataFrame -> DataFrame operators of the pipeline (see README for the inventory)."""
