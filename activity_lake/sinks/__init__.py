"""Writers, batch and streaming."""
