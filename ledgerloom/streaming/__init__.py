"""Reserved: all work in this library is scheduled batch, so no streaming operator is defined."""
