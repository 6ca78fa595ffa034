"""Where events come from, and how batches land."""
