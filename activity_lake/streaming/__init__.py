"""Long-running streams, and the incremental counts they can keep."""
