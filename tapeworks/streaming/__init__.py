"""The same operators on streams."""
