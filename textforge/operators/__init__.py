"""DataFrame-to-DataFrame operators: ordering, hold-out, packing, examples, batches, metrics."""
