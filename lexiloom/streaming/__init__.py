"""Row-local stages on streams."""
