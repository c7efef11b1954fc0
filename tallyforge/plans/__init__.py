"""Named reports composed from operators."""
