"""The persisted work queue and the seen-content filter as streams."""
