"""The row rules on streams."""
