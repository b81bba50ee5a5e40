"""Column functions: every one takes columns and returns a column, so Catalyst sees through them."""

from . import bodies, dates, texts, uris  # noqa: F401
