"""All named queries; importing this package registers them."""

from . import (  # noqa: F401
    aggregates,
    commits,
    documents,
    graph,
    incremental,
    joins,
    picks,
    scalars,
    shape,
    sources,
    tables,
    texts,
)
from .base import REGISTRY  # noqa: F401
