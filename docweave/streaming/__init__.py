"""Progress signals, in batch and as a stream."""
