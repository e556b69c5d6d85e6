"""Streams: an extension; the batch rules applied to arriving records."""
